"""A stand-in for a user's model, which the command-line test names."""

import numpy as np


def load():
    return lambda texts: np.array([[len(t), t.count(" "), 1] for t in texts], dtype=np.float32)
