"""Alignment of two tokenizers, with corpus-wide counts of the pairs of tokens that overlap.

1. Every text is encoded by a byte-level tokenizer A and a piece tokenizer B. Offsets where tokens of both end cut them into groups; an A and a B token
   whose byte ranges overlap are linked. Tasks count in how many of their documents each pair of ids is linked.
2. The distinct pairs get a minimal perfect hash: pairs are dealt to blocks, and each block hashes its pairs to bits of successive levels until none collide;
   the rank of a pair's bit is its index. The pairs stand in a list by index, so that a look-up is verified.
3. Tasks add their counts to dense vectors by index, and vectors of the same block are summed in a tree of two levels. Indexes are taken in slices
   of at most most_pairs, of which one at a time is broadcast.
4. The first pass also writes the figures of every document with its distinct pairs; a second one over these looks the pairs up, so that texts are encoded once. Beyond one
   slice, the pairs of documents meet the counts in a join instead.

Texts are taken apart where both tokenizers are bound to end a token: before a single space, and before a single line break, between characters that aren't
white space; A never joins those, and B only if one of its pieces did (checked when it is loaded; otherwise texts stay whole). A task aligns a repeated part once,
and new parts many at a time, as arrays of the ends of tokens.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import persisted, superseded
from barloom.llm.near_dedup import mix

TOKENIZERS = "/opt/tokenizers"
#: Pairs of a block, levels of its hash at most, and bits of a level for each pair left.
BLOCK_PAIRS, LEVELS, GAMMA = 1 << 14, 200, 1.5
#: A task forgets the parts that it has aligned beyond so many parts or bytes of them.
MOST_PARTS, MOST_PART_BYTES = 1 << 18, 1 << 24
#: Bytes of text that are taken at once.
AT_ONCE = 1 << 20
#: Ways in which the vectors of a block are summed before they are summed to one.
BRANCHES = 16

#: White space that isn't one space or one line break between other characters.
_ODD_SPACE = re.compile(r"\s\s|^\s|\s$|[^\S \n]")
_SPACES = re.compile(r"(\s+)")
# Fixed value: the words that byte-level BPE encodes one by one.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Parts are encoded in lines of about so many characters, which start with a part that is dropped.
LINE, FILLER = 2000, " a"


def parts_of(text: str) -> list[str]:
    """space + text in parts that both tokenizers encode on their own. Those that start with a single space go without it; the others start with white space."""
    if _ODD_SPACE.search(text) is None:
        return text.replace("\n", " \n").split(" ")
    pieces = _SPACES.split(text)
    out, part = [], " " + pieces[0]
    for k in range(1, len(pieces), 2):
        gap, word = pieces[k], pieces[k + 1]
        if (gap == " " or gap == "\n") and word and (k > 1 or pieces[0]):
            out.append(part)
            part = gap + word
        else:
            part += gap + word
    out.append(part)
    return [p[1:] if p[0] == " " and p[1:2] and not p[1].isspace() else p for p in out]


def part_text(part: str) -> str:
    return part if part[:1].isspace() else " " + part


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 bytes as they are and the others, in order, as letters from U+0100."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """A and B from the contents of their files. Where A's merges are in the order of its ids and it has the usual words, its ids are also those of a BPE by ranks, which is faster."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        import tokenizers

        content, letters = json.loads(a), _byte_letters()
        vocabulary = content["model"]["vocab"]
        as_bytes = {t: bytes(letters[c] for c in t) for t in vocabulary}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, k in vocabulary.items():
            self.a_bytes[k] = as_bytes[t]
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        by_rank = content["pre_tokenizer"] == plain and content["normalizer"] is None and all(vocabulary[x + y] == 256 + k for k, (x, y) in enumerate(merges))
        self.ranks = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={as_bytes[t]: k for t, k in vocabulary.items()}, special_tokens={}) if by_rank else None
        self.a = None
        if self.ranks is None:
            self.a = tokenizers.Tokenizer.from_buffer(a)
            self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.apart = not any("▁" in p.lstrip("▁") or len(p) > 1 and "\n" in p for p in pieces)
        self.sizes = [np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes)]

    def parts(self, text: str) -> list[str]:
        return parts_of(text) if self.apart else [" " + text]

    def encode(self, lines: list[str]) -> list[list[list[int]]]:
        """[ids of A for every line, ids of B]; lines start with a space."""
        by_a = self.ranks.encode_ordinary_batch(lines, num_threads=1) if self.a is None else [e.ids for e in self.a.encode_batch(lines, add_special_tokens=False)]
        return [by_a, self.b.encode([x[1:] for x in lines], num_threads=1)]

    def same(self, line: str, a: list[int], b: list[int]) -> bool:
        """Both sequences have the bytes of the line."""
        raw = line.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw


def _in_lines(parts: list[str], whole: bool) -> Iterator[list[int]]:
    """Numbers of parts, line by line. A part that ends with white space ends its line; with whole each part has a line."""
    line, held = [], 0
    for k, part in enumerate(parts):
        line.append(k)
        held += len(part) + 1
        if whole or held > LINE or part[-1:].isspace():
            yield line
            line, held = [], 0
    if line:
        yield line


@dataclass
class Aligned:
    """Tokens of both sides over parts in a row: where they end, their ids, parts and groups; the part of each group; the part and pair of each link. -1: no part."""

    ends: tuple[np.ndarray, ...]
    ids: tuple[np.ndarray, ...]
    part: tuple[np.ndarray, ...]
    group: tuple[np.ndarray, ...]
    group_part: np.ndarray
    link_part: np.ndarray
    link: np.ndarray


def align_parts(tokenizers: Tokenizers, parts: list[str]) -> tuple[Aligned, np.ndarray]:
    """(tokens, groups and links of the parts that come back from both tokenizers, which parts don't)."""
    differs = np.zeros(len(parts), bool)
    first = FILLER if tokenizers.apart else ""
    flat: tuple[list[int], list[int]] = ([], [])
    part_sizes, part_numbers = [], []

    def take(lines: list[list[int]]) -> None:
        texts = [first + "".join([part_text(parts[k]) for k in line]) for line in lines]
        for line, text, a, b in zip(lines, texts, *tokenizers.encode(texts)):
            if tokenizers.same(text, a, b):
                flat[0].extend(a)
                flat[1].extend(b)
                part_sizes.extend([len(first), *(len(part_text(parts[k]).encode()) for k in line)])
                part_numbers.extend([-1, *line])
            elif len(line) == 1:
                differs[line[0]] = True
            else:
                take([[k] for k in line])

    take(list(_in_lines(parts, not tokenizers.apart)))
    number, part_end = np.array(part_numbers, np.int64), np.cumsum(np.array(part_sizes, np.int64))
    ids = tuple(np.array(x, np.int64) for x in flat)
    ends = tuple(np.cumsum(size[x]) for size, x in zip(tokenizers.sizes, ids))
    every = np.sort(np.concatenate(ends), kind="stable")  # two rising runs
    again = np.concatenate([every[1:] == every[:-1], np.zeros(min(1, len(every)), bool)])
    both, every = every[again], every[~again]
    if not np.isin(part_end[part_end > 0], both).all():
        raise ValueError("a token goes on beyond its part")
    of = lambda e: number[np.searchsorted(part_end, e)]
    # Between neighbouring ends lies one token of each side, and each linked pair lies between two such.
    link = ids[0][np.searchsorted(ends[0], every)] << 32 | ids[1][np.searchsorted(ends[1], every)]
    return Aligned(ends, ids, tuple(of(e) for e in ends), tuple(np.searchsorted(both, e) for e in ends), of(both), of(every), link), differs


def group_texts(x: Aligned, n: int) -> list[str]:
    """Of each of n parts its groups, as a1,a2|b1; with a mark behind each group."""
    order, codes, part = [], [], []
    for side in (0, 1):
        last = np.concatenate([x.group[side][1:] != x.group[side][:-1], np.ones(min(1, len(x.ids[side])), bool)])
        codes.append(x.ids[side] << 2 | np.where(last, 1 + side, 0))
        order.append(x.group[side] << 1 | side)
        part.append(x.part[side])
    at = np.argsort(np.concatenate(order), kind="stable")
    code, part = np.concatenate(codes)[at], np.concatenate(part)[at]
    code, part = code[part >= 0], part[part >= 0]
    unique, back = np.unique(code, return_inverse=True)
    atoms = [f"{c >> 2}{',|;'[c & 3]}" for c in unique.tolist()]
    atoms = list(map(atoms.__getitem__, back.tolist()))
    out = [""] * n
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
    for k, i, j in zip(part[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(part)]):
        out[k] = "".join(atoms[i:j])
    return out


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, with sums of n."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class Numbers(dict):
    """Numbers new keys in order."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


@dataclass
class Parts:
    """What a task knows of the parts it has met: figures by part, and links as numbers of pairs; with texts also the groups."""

    tokenizers: Tokenizers
    texts: bool = False
    number: Numbers = field(default_factory=Numbers)
    figures: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), np.int64))  # n_a, n_b, n_groups, differs
    groups: list[str] = field(default_factory=list)
    links: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    first_link: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    pair_number: Numbers = field(default_factory=Numbers)
    held: int = 0

    def full(self) -> bool:
        return len(self.number) > MOST_PARTS or self.held > MOST_PART_BYTES

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the parts of all texts in order, where each text's begin); unknown parts are aligned first."""
        known, flat, first = len(self.number), [], [0]
        for text in texts:
            if text:
                flat.extend(map(self.number.__getitem__, self.tokenizers.parts(text)))
            first.append(len(flat))
        if len(self.number) > known:
            self._learn(list(itertools.islice(reversed(self.number), len(self.number) - known))[::-1])
        return np.array(flat, np.int64), np.array(first)

    def _learn(self, fresh: list[str]) -> None:
        n = len(fresh)
        self.held += sum(map(len, fresh))
        x, differs = align_parts(self.tokenizers, fresh)
        count = lambda part: np.bincount(part[part >= 0], minlength=n)
        self.figures = np.concatenate([self.figures, np.column_stack([count(x.part[0]), count(x.part[1]), count(x.group_part), differs])])
        if self.texts:
            self.groups += group_texts(x, n)
        at = np.flatnonzero(x.link_part >= 0)
        at = at[np.argsort(x.link_part[at], kind="stable")]
        pairs, back = np.unique(x.link[at], return_inverse=True)
        self.links = np.concatenate([self.links, np.fromiter(map(self.pair_number.__getitem__, pairs.tolist()), np.int64, len(pairs))[back]])
        self.first_link = np.concatenate([self.first_link, self.first_link[-1] + np.cumsum(count(x.link_part))])

    def pairs(self) -> np.ndarray:
        """The pairs by number, as A's id * 2^32 + B's id."""
        return np.fromiter(self.pair_number, np.int64, len(self.pair_number))

    def document_pairs(self, flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair number, links) of the distinct pairs of each text that counts."""
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        one, times = _counted(doc << 32 | flat, np.ones(len(flat), np.int64))
        doc, part = one >> 32, one & 0xFFFFFFFF
        sizes = self.first_link[part + 1] - self.first_link[part]
        at = np.repeat(self.first_link[part] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        keys, links = _counted(np.repeat(doc, sizes) << 32 | self.links[at], np.repeat(times, sizes))
        return keys >> 32, keys & 0xFFFFFFFF, links


def _slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in batches of about AT_ONCE bytes of text, so that what a task holds at once doesn't depend on the size of Spark's batches."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)) // AT_ONCE
        cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), b.num_rows]
        for i, j in itertools.pairwise(cuts):
            if j > i:
                yield b.slice(i, j - i)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the stretches of values that begin at first."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    return total[first[1:]] - total[first[:-1]]


def _without(parts: Parts, flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of the texts without those of texts that have no tokens, as some part's bytes differ; and which these are."""
    differs = _sums(parts.figures[flat, 3], first) > 0
    sizes = np.diff(first)
    flat = flat[np.repeat(~differs, sizes)]
    return flat, np.concatenate([[0], np.cumsum(np.where(differs, 0, sizes))]), differs


def spread(pairs: np.ndarray) -> np.ndarray:
    """A hash of 63 bits, which deals pairs to blocks."""
    return (mix(pairs.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)).astype(np.int64)


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The stretches of values between the bounds, as bytes."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _figures(parts: Parts, flat: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    """What of the contract's figures needs no counts."""
    figures, numbers = _sums(parts.figures[flat], first), flat.tolist()
    shas = [hashlib.sha256("".join(map(parts.groups.__getitem__, numbers[i:j]))[:-1].encode()).hexdigest() if j > i else "" for i, j in itertools.pairwise(first.tolist())]
    columns = {name: pa.array(figures[:, k]) for k, name in enumerate(("n_a", "n_b", "n_groups"))}
    return columns | {"n_links": pa.array(_sums(np.diff(parts.first_link)[flat], first)), "groups_sha256": pa.array(shas, pa.string())}


#: Columns of _align() behind the id.
_ALIGNED = {
    "version": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "pairs": pa.binary(), "links": pa.binary(),
    "pair": pa.int64(), "spread": pa.int64(), "n": pa.int64(),
}
_ALIGNED_SQL = ", ".join(f"{c} { {pa.int64(): 'bigint', pa.string(): 'string', pa.binary(): 'binary'}[t] }" for c, t in _ALIGNED.items())


def _align(files):
    """Rows of two kinds. Every text: its figures, distinct pairs (8 bytes each) and how often it links each (4 bytes). And with a pair: documents of this task that link it; a pair may have several rows."""
    def rows(id_type: pa.DataType, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_pydict({c: columns[c] if c in columns else pa.nulls(n, t) for c, t in ({"id": id_type} | _ALIGNED).items()})

    def counted(id_type: pa.DataType, parts: Parts, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        pairs = parts.pairs()
        for k in range(0, len(pairs), 100_000):
            own = pairs[k : k + 100_000]
            yield rows(id_type, {"pair": pa.array(own), "spread": pa.array(spread(own)), "n": pa.array(counts[k : k + 100_000])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = counts = id_type = None
        for b in _slices(batches):
            parts, id_type = parts or Parts(Tokenizers(*files.value), True), b.column("id").type
            flat, first, _ = _without(parts, *parts.of(b.column("text").to_pylist()))
            doc, pair, links = parts.document_pairs(flat, first)
            new = np.bincount(pair, minlength=len(parts.pair_number))
            new[: 0 if counts is None else len(counts)] += 0 if counts is None else counts
            counts = new
            bounds = np.searchsorted(doc, np.arange(b.num_rows + 1))
            yield rows(id_type, {"id": b.column("id"), "version": b.column("version"), "pairs": _cut(parts.pairs()[pair], bounds), "links": _cut(links.astype(np.int32), bounds)} | _figures(parts, flat, first))
            if parts.full():
                yield from counted(id_type, parts, counts)
                parts, counts = Parts(parts.tokenizers, True), None
        if counts is not None:
            yield from counted(id_type, parts, counts)

    return run


def _slots(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (mix(pairs.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(level * 0x632BE59BD9B4E019 % (1 << 64))) % np.asarray(size, np.uint64)).astype(np.int64)


def minimal_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes of the levels, bits of all levels, pairs in the order of their indexes) for distinct pairs."""
    sizes, bits, ordered, left = [], [], [], pairs
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("pairs repeat")
        size = int(GAMMA * len(left)) + 1
        at = _slots(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        sizes.append(size)
        bits.append(alone)
        ordered.append(left[placed][np.argsort(at[placed])])
        left = left[~placed]
    return sizes, np.concatenate([*bits, np.zeros(0, bool)]), np.concatenate([*ordered, pairs[:0]])


_BLOCKS = "block bigint, sizes array<int>, bits binary, pairs array<bigint>"


def _hash_block(table: pa.Table) -> pa.Table:
    sizes, bits, ordered = minimal_hash(table.column("pair").to_numpy())
    return pa.table({"block": table.column("block")[:1], "sizes": pa.array([sizes], pa.list_(pa.int32())), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()), "pairs": pa.array([ordered], pa.list_(pa.int64()))})


class PairTable:
    """Indexes of the pairs of some blocks; blocks is their number in all, rows are (block, sizes, bits, pairs) by block."""

    def __init__(self, blocks: int, rows: list[tuple[int, list[int], bytes, np.ndarray]]):
        self.blocks = blocks
        self.level = np.full(blocks + 1, -1, np.int64)  # the first level of each block that is here
        sizes, bits, at = [], [], 0
        for block, own, packed, _ in rows:
            self.level[block] = at
            sizes += [*own, 0]  # ends with an empty level
            at += len(own) + 1
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(own)).astype(bool))
        self.size = np.array(sizes, np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bit = np.concatenate([*bits, np.zeros(0, bool)])
        self.rank = np.cumsum(self.bit, dtype=np.int32) - 1
        self.pairs = np.concatenate([*(p for *_, p in rows), np.zeros(0, np.int64)])
        #: Where the pairs of each row begin.
        self.first = np.concatenate([[0], np.cumsum([len(p) for *_, p in rows])]).astype(np.int64)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Indexes, -1 for pairs that aren't here."""
        out = np.full(len(pairs), -1, np.int64)
        here, depth = np.arange(len(pairs)), 0
        level = self.level[spread(pairs) % self.blocks]
        here, level = here[level >= 0], level[level >= 0]
        while len(here):
            on = self.size[level] > 0
            here, level = here[on], level[on]
            at = self.start[level] + _slots(pairs[here], depth, self.size[level])
            hit = self.bit[at]
            out[here[hit]] = self.rank[at[hit]]
            here, level, depth = here[~hit], level[~hit] + 1, depth + 1
        found = np.flatnonzero(out >= 0)
        out[found[self.pairs[out[found]] != pairs[found]]] = -1
        return out


def _dense(table):
    """(block number in the slice, vector) of the counts of this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = None, None
        for b in batches:
            if known is None:
                known = PairTable(*table.value)
                total = np.zeros(len(known.pairs), np.int64)
            index = known.find(b.column("pair").to_numpy())
            found = index >= 0
            np.add.at(total, index[found], b.column("n").to_numpy()[found])
        for k in range(0 if known is None else len(known.first) - 1):
            own = total[known.first[k] : known.first[k + 1]]
            if own.any():
                yield pa.RecordBatch.from_pydict({"row": pa.array([k], pa.int32()), "counts": pa.array([own], pa.list_(pa.int64()))})

    return run


def _vector_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for k, counts in zip(b.column("row").to_pylist(), b.column("counts")):
            own = counts.values.to_numpy()
            held[k] = held[k] + own if k in held else own
    for k, own in held.items():
        yield pa.RecordBatch.from_pydict({"row": pa.array([k], pa.int32()), "counts": pa.array([own], pa.list_(pa.int64()))})


def _slice(blocks: int, model: DataFrame, low: int, high: int) -> tuple[int, list]:
    rows = model.where((F.col("block") >= low) & (F.col("block") < high)).orderBy("block").toArrow()
    return blocks, [(rows.column("block")[k].as_py(), rows.column("sizes")[k].as_py(), rows.column("bits")[k].as_py(), rows.column("pairs")[k].values.to_numpy()) for k in range(rows.num_rows)]


def _block(blocks: int) -> Column:
    return F.col("spread") % blocks


def _add_up(counted: DataFrame, table: tuple[int, list], blocks: int, low: int, high: int) -> list[np.ndarray]:
    """Counts by index of the blocks low to high - 1, which table holds, one vector a row of it."""
    spark = counted.sparkSession
    shared = spark.sparkContext.broadcast(table)
    vectors = counted.where((_block(blocks) >= low) & (_block(blocks) < high)).mapInArrow(_dense(shared), "row int, counts array<bigint>")
    branch = F.spark_partition_id() % BRANCHES
    summed = vectors.withColumn("branch", branch).repartition("row", "branch").select("row", "counts").mapInArrow(_vector_sums, "row int, counts array<bigint>")
    rows = summed.repartition("row").mapInArrow(_vector_sums, "row int, counts array<bigint>").toArrow()
    shared.destroy()
    found = {rows.column("row")[k].as_py(): rows.column("counts")[k].values.to_numpy() for k in range(rows.num_rows)}
    return [found[k] for k in range(len(table[1]))]


_OUT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _score(table):
    """Figures of every text, with n_best and count_sum by look-up of its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for b in _slices(batches, "pairs"):
            if known is None:
                content, counts, tops = table.value
                known = PairTable(*content)
            pairs, links, first = _stored(b)
            count = counts[known.find(pairs)]
            sums = _sums(np.column_stack([np.where(count == tops[pairs >> 32], links, 0), links * count]), first)
            columns = {c: b.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")} | {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])}
            yield pa.RecordBatch.from_pydict(columns | {"groups_sha256": b.column("groups_sha256")})

    return run


def _stored(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs and links of all texts, where each text's begin) as _align() wrote them."""
    pairs, links = (np.frombuffer(b"".join(b.column(c).to_pylist()), t) for c, t in (("pairs", np.int64), ("links", np.int32)))
    return pairs, links.astype(np.int64), np.concatenate([[0], np.cumsum(pc.binary_length(b.column("pairs")).to_numpy(zero_copy_only=False) // 8)]).astype(np.int64)


def _document_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, version, pair, links): distinct pairs of every text."""
    for b in _slices(batches, "pairs"):
        pairs, links, first = _stored(b)
        doc = np.repeat(np.arange(b.num_rows), np.diff(first))
        for k in range(0, len(doc), 100_000):
            own, take = slice(k, k + 100_000), pa.array(doc[k : k + 100_000])
            yield pa.RecordBatch.from_pydict({"id": b.column("id").take(take), "version": b.column("version").take(take), "pair": pa.array(pairs[own]), "links": pa.array(links[own])})


def _files(docs: DataFrame, tokenizers_dir: str, a: str, b: str):
    """The two vocabulary files, broadcast: a few MB, whatever the documents."""
    out = []
    for name in (a, b):
        with open(f"{tokenizers_dir}/{name}", "rb") as f:
            out.append(f.read())
    return docs.sparkSession.sparkContext.broadcast(tuple(out))


def alignment(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizers_dir: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", most_pairs: int = 1 << 22
) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    A encodes a space and the text, B the text. A text that is null or empty, or whose bytes don't come back from both tokenizers, has no tokens: zeros and
    an empty digest. The count of a pair of ids is the number of rows that link it; n_best links have the highest count of their A id. Repeated rows count
    as rows and get the same result; null identifiers stay null; an empty table gives an empty result; other columns are ignored.

    At most most_pairs distinct pairs (about 20 bytes each, unpacked 30) are broadcast at once; the result is the same for any number.
    """
    spark = docs.sparkSession
    files = _files(docs, tokenizers_dir, a, b)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    aligned = persisted(base.mapInArrow(_align(files), f"id {kind}, {_ALIGNED_SQL}"))
    counted = aligned.where("pair IS NOT NULL").select("pair", "spread", "n")
    figures = aligned.where("pair IS NULL").drop("pair", "spread", "n")
    distinct = persisted(counted.select("pair", "spread").distinct())
    n = distinct.count()
    blocks = max(1, n // min(BLOCK_PAIRS, most_pairs))
    model = persisted(distinct.select(_block(blocks).alias("block"), "pair").groupBy("block").applyInArrow(_hash_block, _BLOCKS))
    step = max(1, blocks * most_pairs // max(1, n))
    slices, tops = [], np.zeros(0, np.int64)
    for low in range(0, blocks, step):
        table = _slice(blocks, model, low, low + step)
        vectors = _add_up(counted, table, blocks, low, low + step)
        own = np.concatenate([p for *_, p in table[1]]) if table[1] else np.zeros(0, np.int64)
        counts = np.concatenate([*vectors, np.zeros(0, np.int64)])
        highest = np.zeros(max(len(tops), int((own >> 32).max(initial=-1)) + 1), np.int64)
        highest[: len(tops)] = tops
        np.maximum.at(highest, own >> 32, counts)
        tops = highest  # one number for each id of A
        if blocks <= step:
            shared = spark.sparkContext.broadcast((table, counts, tops))
            superseded(distinct, model)
            return figures.mapInArrow(_score(shared), f"id {kind}, {_OUT}").withColumnRenamed("id", id_col)
        slices.append(persisted(spark.createDataFrame(pa.table({"pair": own, "n": counts}))))
    best = spark.createDataFrame(pa.table({"a": np.arange(len(tops)), "top": tops}))  # as many rows as A has ids
    known = slices[0]
    for more in slices[1:]:
        known = known.unionByName(more)
    known = persisted(known.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("is_best")))
    superseded(distinct, model, *slices)
    links = figures.select("id", "version", "pairs", "links").mapInArrow(_document_links, f"id {kind}, version bigint, pair bigint, links bigint")
    rows = base.groupBy("id", "version").agg(F.count("*").alias("copies"))
    sums = links.join(known.hint("merge"), "pair").groupBy("id", "version").agg(F.sum(F.col("links") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("is_best"), F.col("links")).otherwise(0)).alias("n_best"))
    same = lambda x, y: x["id"].eqNullSafe(y["id"]) & (x["version"] == y["version"])
    sums = persisted(sums.join(rows, same(sums, rows)).select(sums["id"], sums["version"], *[F.expr(f"{c} div copies").alias(c) for c in ("count_sum", "n_best")]))
    zero = lambda c: F.coalesce(sums[c], F.lit(0)).cast("bigint").alias(c)
    return figures.join(sums, same(figures, sums), "left").select(figures["id"].alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
