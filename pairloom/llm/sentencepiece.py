"""Encoding and decoding with a SentencePiece model of the merge type, without the library.

A text is cut where no merge can reach across: before a run of space marks, when no piece has a mark behind
another character, between a letter and a stop that follows a letter in no piece, and at characters no piece holds. Each cut is encoded by backtracking (Aho-Corasick longest
matches, neighbours checked by merging their text again, a bit field of positions that failed), which gives
the merge result in linear time. Cuts repeat often, so a task keeps a bounded table of them.

Null text counts as empty and has no ids. Nothing depends on other columns, order or repeats.
"""

from __future__ import annotations

import hashlib
import re
import struct

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.llm.common import id_and_text, tidy

SPACE = "▁"
# The piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
LETTER = r"[^\W\d_²³¹]"
STOPS = ",.;:!?*|&%$#"
KEPT_CUTS = 200_000
KEPT_LENGTH = 48
KEPT_PAIRS = 250_000


def _fields(data: bytes):
    """The (number, value) fields of one protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


class PieceModel:
    """The vocabulary of a model file, and encoding and decoding with it."""

    def __init__(self, data: bytes):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        scores, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                self.kinds.append(piece.get(3, NORMAL))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != BPE or not trainer.get(35):
            raise ValueError("a merge model with byte fallback is needed")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("text rewriting, user-defined and unused pieces are not supported")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}
        self.score = {t: scores[i] for t, i in self.ids.items()}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.letters = {c for t in self.ids for c in t}
        if not self.letters <= set(self.ids):
            raise ValueError("each character of a piece has to be a piece")
        self.matcher = ahocorasick.Automaton()
        for text in self.ids:
            self.matcher.add_word(text, len(text))
        self.matcher.make_automaton()
        barred = re.escape("".join(c for c in map(chr, range(32)) if c not in self.letters))
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.ids):
            self.cuts = re.compile(f"[^{barred}]+|[{barred}]" if barred else r"(?s).+")
        else:
            stops = "".join(re.escape(c) for c in STOPS if not any(re.search(f"{LETTER}{re.escape(c)}", t) for t in self.ids))
            whole = f"{SPACE}+{LETTER}+(?=[{stops}])|" if stops else ""
            self.cuts = re.compile(f"{whole}{SPACE}+[^{SPACE}{barred}]*|[^{SPACE}{barred}]+" + (f"|[{barred}]" if barred else ""))
        self.sizes = [len(t) for t in self.texts]
        # The longest piece that is a proper prefix of a piece; -1 when there is none.
        self.shorter = [next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1) for t in self.texts]
        self._pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The merges done one by one: the best-scored pair first, of equal ones the leftmost."""
        parts, score, lowest = list(text), self.score, float("-inf")
        values = [score.get(a + b, lowest) for a, b in zip(parts, parts[1:])]
        while values and (best := max(values)) > lowest:
            at = values.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del values[at]
            if at:
                values[at - 1] = score.get(parts[at - 1] + parts[at], lowest)
            if at < len(values):
                values[at] = score.get(parts[at] + parts[at + 1], lowest)
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the text of two neighbours again gives the same two; ``left`` is -1 at the beginning."""
        if len(self._pairs) >= KEPT_PAIRS:
            self._pairs.clear()
        pair = [self.texts[right]] if left < 0 else [self.texts[left], self.texts[right]]
        fits = self._pairs[left * len(self.texts) + right] = self.merged("".join(pair)) == pair
        return fits

    def _backtrack(self, text: str) -> list[int]:
        """Pieces of a run of known characters."""
        n, ids, sizes, shorter, pairs, total = len(text), self.ids, self.sizes, self.shorter, self._pairs, len(self.texts)
        longest = [1] * n
        for end, size in self.matcher.iter(text):
            if size > 1 and size > longest[end - size + 1]:
                longest[end - size + 1] = size
        failed = bytearray(n + 1)
        out: list[int] = []
        at, piece, last = 0, ids[text[:longest[0]]], -1
        while True:
            while piece >= 0:
                end = at + sizes[piece]
                if not failed[end]:
                    fits = pairs.get(last * total + piece)
                    if self._fits(last, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                if end == n:
                    return out
                at, last = end, piece
                piece = ids[text[at:at + longest[at]]]
            else:
                failed[at] = 1
                piece = out.pop()
                at -= sizes[piece]
                piece, last = shorter[piece], out[-1] if out else -1

    def encode_cut(self, cut: str) -> list[int]:
        if self.letters.issuperset(cut):
            return self._backtrack(cut)
        out, run, letters = [], 0, self.letters
        for i, c in enumerate(cut):
            if c not in letters:
                if run < i:
                    out += self._backtrack(cut[run:i])
                out += [self.bytes[b] for b in c.encode()]
                run = i + 1
        if run < len(cut):
            out += self._backtrack(cut[run:])
        return out

    def split(self, text: str) -> list[str]:
        return self.cuts.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for cut in self.split(text) for i in self.encode_cut(cut)]

    def decode_part(self, ids: list[int]) -> str:
        """Text of some ids, with the mark of the beginning still in it."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_utf8(held))
                held = bytearray()
            if self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif self.kinds[i] != CONTROL:
                out.append(self.texts[i].replace(SPACE, " "))
        if held:
            out.append(_utf8(held))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        if self.prefix and first is not None and self.kinds[first] == NORMAL and text.startswith(" "):
            return text[1:]
        return text


def _utf8(data: bytearray) -> str:
    """Bytes as text; each byte that begins no character becomes a replacement character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class _Cuts(dict):
    """Encoded cuts of one task: decimal ids joined by commas, and their text."""

    def __init__(self, model: PieceModel):
        self.model = model

    def __missing__(self, cut: str):
        ids = self.model.encode_cut(cut)
        value = ",".join(map(str, ids)), self.model.decode_part(ids)
        if len(cut) <= KEPT_LENGTH:
            if len(self) >= KEPT_CUTS:
                self.clear()
            self[cut] = value
        return value


_loaded: dict = {}


def _model(data: bytes) -> PieceModel:
    """The model, read once for all tasks of a worker."""
    key = hashlib.md5(data).digest()
    if key not in _loaded:
        _loaded[key] = PieceModel(data)
    return _loaded[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, model_path: str, with_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, with ``with_text`` also ``ids`` (comma-joined) and ``decoded``.

    One narrow pass, no shuffle. The model file is read on the driver and sent to the executors; its size does
    not depend on the documents.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    @tidy
    def run(batches):
        cuts = _Cuts(_model(sent.value))
        split = cuts.model.split
        for batch in batches:
            counts, id_hashes, text_hashes, ids_out, texts_out = [], [], [], [], []
            for value in batch.column(1):
                parts = [cuts[c] for c in split(value.as_py())]
                ids = ",".join([p[0] for p in parts])
                text = "".join([p[1] for p in parts])
                if cuts.model.prefix and text.startswith(" "):
                    text = text[1:]
                counts.append(ids.count(",") + 1 if ids else 0)
                id_hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                text_hashes.append(hashlib.sha256(text.encode()).hexdigest())
                if with_text:
                    ids_out.append(ids)
                    texts_out.append(text)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes), pa.array(text_hashes)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_text:
                columns, names = columns + [pa.array(ids_out, pa.string()), pa.array(texts_out, pa.string())], names + ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs).mapInArrow(run, schema + (", ids string, decoded string" if with_text else ""))
