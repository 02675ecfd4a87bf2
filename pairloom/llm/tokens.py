"""Token ids of whole texts from public vocabulary files, for operators that need ids and their bytes."""

from __future__ import annotations

import functools
import json

import numpy as np
import public_tokenizers
import regex
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

SPACE = "▁"
LONG_WORD = 2000  # the quick encoder is quadratic in one word, so texts with longer ones go to the other library


def _bytes_of_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _long_word(text: str) -> bool:
    """Whether a word is longer than ``LONG_WORD``; such a one fills a block of half that length that has no space or nothing else."""
    half = LONG_WORD // 2
    for at in range(0, len(text) - half + 1, half):
        block = text[at:at + half]
        if " " not in block or block.isspace():
            return max(map(len, regex.findall(public_tokenizers.PATTERN, text))) > LONG_WORD
    return False


class ByteTokens:
    """A byte-level merge vocabulary from its JSON file: ids as its own library gives them, without ids put around a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        if described["pre_tokenizer"]["type"] != "ByteLevel" or described["pre_tokenizer"]["add_prefix_space"] or described["normalizer"]:
            raise ValueError("a byte-level vocabulary without rewriting is needed")
        of = _bytes_of_letters()
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        known = {t: i for t, i in described["model"]["vocab"].items() if t not in self.special}
        self.bytes = [b""] * (max([*known.values(), *self.special.values()]) + 1)
        for text, i in known.items():
            self.bytes[i] = bytes(of[c] for c in text)
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self._known, self._path = known, path

    @functools.cached_property
    def _quick(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, special_tokens=self.special,
                                 mergeable_ranks={self.bytes[i]: i for i in self._known.values()})

    @functools.cached_property
    def _whole(self) -> Tokenizer:
        return Tokenizer.from_file(self._path)

    def encode(self, text: str, plain: bool = False) -> np.ndarray:
        """Ids of a text; with ``plain`` the strings of special tokens in it are ordinary text."""
        if _long_word(text):
            self._whole.encode_special_tokens = plain
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._quick.encode_to_numpy(text, allowed_special=set() if plain else "all", disallowed_special=())


class PieceTokens:
    """A SentencePiece vocabulary from its model file."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown, self.bytes = self._model.unk_id(), []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace(SPACE, " ").encode())

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


# One copy for all tasks of a worker. The files stand at the same path on every machine, as their package does.
@functools.lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@functools.lru_cache(maxsize=2)
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)
