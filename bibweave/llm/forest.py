"""Keys under which titles find each other: a forest of min-hash signatures over letters, and starts of titles.

A signature is a permutation's min-hashes, a byte each, as one number: titles
whose signatures of a tree begin with the same bytes stand together when the
tree is sorted.  Neither blanks nor the order of main title and subtitle count,
nor how many words are damaged.  Titles cut short are found by their first
letters: index titles give keys of each part that may stand first, cut titles
(and titles that may have been cut without a mark) ask with theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

CJK = re.compile(r"[ぁ-ヿ一-鿿]")
TREES, LENGTH = 16, 8
BARE_TREES = 5  # trees that are also kept without an author, for records that have none
START = 12  # letters of the shortest start; half as many for Japanese
#: What a key row holds: a key with an author, one without of a record that has authors, and one of a record without any.
NAMED, BARE, NAMELESS = 0, 1, 2
#: The last two for keys of whole titles.
WHOLE_BARE, WHOLE_NAMELESS = 3, 4

_rng = np.random.default_rng(11)
_A = _rng.integers(1, 1 << 32, TREES * LENGTH, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, TREES * LENGTH, dtype=np.uint32)


def signatures(titles: list[str], length: int = LENGTH, trees: int = TREES) -> np.ndarray:
    """(titles, trees) signatures, the first min-hash in the highest of ``length`` bytes."""
    out = np.zeros((len(titles), trees), np.uint64)
    if not titles:
        return out
    padded = [t if len(t) >= 3 else t.ljust(3, "_") for t in titles]
    sizes = np.array([len(t) + 2 for t in padded])
    codes = np.frombuffer("".join(t + t[:2] for t in padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    grams = np.empty(len(codes), np.uint32)
    grams[:-2] = (codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1]) * np.uint32(0x85EBCA6B) ^ codes[2:]
    grams *= np.uint32(0xC2B2AE35)
    grams ^= grams >> np.uint32(15)
    for back in (1, 2):  # the last two places of a title would reach into the next one
        grams[at + sizes - back] = grams[at]
    for t in range(trees):
        for k in range(length):
            least = np.minimum.reduceat(grams * _A[t * LENGTH + k] + _B[t * LENGTH + k], at)
            out[:, t] = out[:, t] << np.uint64(8) | (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint64)
    return out


KEY_BITS = 48  # keys only bring candidates together, which are then compared, so short ones, that take less room in a shuffle, will do


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A key of whole numbers."""
    key = np.full(1, 0x243F6A8885A308D3, np.uint64)  # arrays wrap around silently
    for p in parts:
        key = (key ^ np.asarray(p).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key = key ^ key >> np.uint64(29)
    return (key >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def text_key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def short_key(kind: int, piece: str, name: int = 0) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\x1f{piece}\x1f{name}".encode("utf-8", "surrogatepass")) >> (64 - KEY_BITS)


def _pieces(letters: str, at: int, shift: int = 0) -> list[tuple[int, str]]:
    """(kind, letters) of a title read from a place: 1 the first letters, 2 twice as many, 3 twice as many and 4 as many behind the first."""
    s = letters[at:] + letters[:at] if at else letters
    u = START // 2 if not s.isascii() and CJK.search(s[: 2 * START]) else START
    out = [(1, s[:u])] if len(s) >= u else []
    if len(s) >= 2 * u:
        out.append((2, s[: 2 * u]))
        if len(s) > 2 * u:
            out.append((4, s[u + shift : 2 * u + shift]))
    if len(s) > 3 * u:
        out.append((3, s[u + shift : 3 * u + shift]))
    return out


def start_keys(letters: str, breaks: list[int], name: int) -> list[tuple[int, int]]:
    """(key, role) under which a title is found by its start."""
    found = []
    for at in (0, *breaks):
        for kind, piece in _pieces(letters, at):
            if name and kind < 4:
                found.append((short_key(kind, piece, name), NAMED))
            if kind in (1, 4):
                found.append((short_key(kind, piece), BARE if name else NAMELESS))
    return found


def start_probes(letters: str, cut: bool, name: int) -> list[tuple[int, int]]:
    """(key, role) with which a title looks for those it is the start of. Slips shift what stands behind them."""
    pieces = _pieces(letters, 0)
    if not cut:
        return [(short_key(kind, piece, name), NAMED) for kind, piece in pieces if kind == 2] if name else []
    shifted = [p for d in (-1, 1) for p in _pieces(letters, 0, d) if p[0] > 2]
    found = [(short_key(kind, piece, name), NAMED) for kind, piece in pieces + shifted if kind < 4 and (kind > 1 or len(pieces) < 4)] if name else []
    return found + [(short_key(kind, piece), BARE if name else NAMELESS) for kind, piece in pieces + shifted if kind in (1, 4)]


Keys = tuple[np.ndarray, np.ndarray, np.ndarray]


def _listed(node: np.ndarray, found: list[list[tuple[int, int]]]) -> Keys:
    """(keys, nodes, roles) of each node's own list of keys."""
    sizes = [len(own) for own in found]
    flat = np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int64, 2 * sum(sizes)).reshape(-1, 2)
    return flat[:, 0], np.repeat(node, sizes), flat[:, 1]


def _flat(rows: Keys | None, more: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    """A batch (k, node, role) of listed keys and of arrays of keys with their nodes."""
    parts = ([rows] if rows else []) + [(k, n, np.full(len(k), role)) for k, n, role in more]
    k, node, role = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(k), pa.array(node), pa.array(role.astype(np.int32))], names=["k", "node", "role"])


KEYS = "k long, node long, role int"


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str], list[list[int]], list[bool], np.ndarray, np.ndarray]:
    node, first, least = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "first", "least"))
    return node, batch.column("letters").to_pylist(), batch.column("breaks").to_pylist(), batch.column("cut").to_pylist(), first, least


def slip_rows(depth: int, trees: int = TREES):
    """Rows of anchored titles -> (k, node, role) of every tree: half of the trees go with the first author, half with the least name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, letters, _, _, first, least = _columns(batch)
            named = np.flatnonzero(first != 0)
            sig = signatures([letters[i] for i in named], depth, trees)
            names = (first[named], least[named])
            yield _flat(None, [(mixed(t, sig[:, t], names[2 * t >= trees]), node[named], NAMED) for t in range(trees)])

    return run


def index_rows(depth: int):
    """Rows of anchored titles -> (k, node, role) by which a probe finds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, letters, breaks, _, first, _ = _columns(batch)
            rows = _listed(node, [start_keys(x, b, f) for x, b, f in zip(letters, breaks, first.tolist())])
            sig = signatures(letters, depth, BARE_TREES)
            less = first == 0
            more = [(mixed(100 + t, sig[w, t]), node[w], role) for t in range(BARE_TREES) for w, role in ((less, WHOLE_NAMELESS), (~less, WHOLE_BARE))]
            yield _flat(rows, more)

    return run


def probe_rows(depth: int):
    """Rows of anchored titles -> (k, node, role) of cut titles, titles that may be cut, and titles without authors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, letters, _, cut, first, _ = _columns(batch)
            rows = _listed(node, [start_probes(x, c, f) for x, c, f in zip(letters, cut, first.tolist())])
            less = np.flatnonzero(first == 0)
            sig = signatures([letters[i] for i in less], depth, BARE_TREES)
            yield _flat(rows, [(mixed(100 + t, sig[:, t]), node[less], WHOLE_NAMELESS) for t in range(BARE_TREES)])

    return run
