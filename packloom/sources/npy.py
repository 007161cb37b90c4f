"""The npy container: header and rows of a two-dimensional float array, read and written piece by piece."""

from __future__ import annotations

import ast
import struct
from typing import BinaryIO

import numpy as np

MAGIC = b"\x93NUMPY"


def read_header(f: BinaryIO) -> tuple[np.dtype, tuple[int, ...], bool]:
    """Type, shape and whether columns are contiguous; ``f`` is left at the data."""
    if f.read(6) != MAGIC:
        raise ValueError("not an npy file")
    major, _ = f.read(2)
    n = struct.unpack("<H", f.read(2))[0] if major == 1 else struct.unpack("<I", f.read(4))[0]
    d = ast.literal_eval(f.read(n).decode("latin1"))
    return np.dtype(d["descr"]), tuple(d["shape"]), d["fortran_order"]


def header(rows: int, columns: int, kind: str = "<f4") -> bytes:
    """The header of a matrix in row order, padded so that data begins at a multiple of 64."""
    text = f"{{'descr': '{kind}', 'fortran_order': False, 'shape': ({rows}, {columns}), }}"
    text += " " * (-(len(text) + 11) % 64) + "\n"
    return MAGIC + b"\x01\x00" + struct.pack("<H", len(text)) + text.encode("latin1")


def read_rows(f: BinaryIO, first: int, count: int) -> np.ndarray:
    """``count`` rows from row ``first``; ``f`` stands at the file's beginning."""
    kind, shape, columns_first = read_header(f)
    if columns_first:
        return np.frombuffer(f.read(), kind).reshape(shape[::-1]).T[first : first + count]
    width = int(np.prod(shape[1:], dtype=np.int64)) if len(shape) > 1 else 1
    if not width or not shape[0]:
        return np.zeros((0, width), kind)
    size = width * kind.itemsize
    if f.seekable():
        f.seek(first * size, 1)
    else:
        f.read(first * size)
    return np.frombuffer(f.read(count * size), kind).reshape(-1, width)
