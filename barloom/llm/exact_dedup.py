"""Exact dedup with Patricia tries.

Texts are dealt by (length, SHA-256); the task that owns a partition inserts the full byte strings into
compressed radix tries, so equality is decided on bytes and never on a digest alone; rows find their owner by digest only where the tries hold one
text of that digest, else by the text. A terminal node stores the
identifier that stays and the number of rows. A trie over its byte budget spills its heaviest subtree to a task-local
temporary file, and that subtree is finished from the file afterwards. Before the shuffle each task already merges
its own equal texts in such a trie, so a text that holds a third of all rows is shuffled once per input task.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ascii_lower, join_counted, persisted

_LABEL, _KIDS, _ENTRY, _FILE = range(4)


def _common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b[at:], by bisection on slices."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaOwners:
    """Maps byte strings to [identifier that stays, rows, payload]; subtrees spill beyond budget bytes.

    A node is [label, children by first byte, entry or None, spill file or None].
    """

    def __init__(self, budget: int, largest: bool = True):
        self.budget, self.largest, self.held = budget, largest, 0
        self.root = [b"", {}, None, None]

    def _merge(self, entry: list | None, keep, rows: int, payload) -> list:
        if entry is None:
            return [keep, rows, payload]
        if keep is not None and (entry[0] is None or (keep > entry[0] if self.largest else keep < entry[0])):
            entry[0] = keep
        entry[1] += rows
        return entry

    def insert(self, text: bytes, keep, rows: int, payload) -> None:
        node, at = self.root, 0
        while True:
            if node[_FILE] is not None:
                pickle.dump((text[at:], keep, rows, payload), node[_FILE], protocol=5)
                return
            if at == len(text):
                node[_ENTRY] = self._merge(node[_ENTRY], keep, rows, payload)
                return
            child = node[_KIDS].get(text[at])
            if child is None:
                node[_KIDS][text[at]] = [text[at:], {}, [keep, rows, payload], None]
                self.held += len(text) - at + 200
                break
            label = child[_LABEL]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common_prefix(label, text, at)
            middle = [label[:same], {label[same]: child}, None, None]
            child[_LABEL] = label[same:]
            node[_KIDS][text[at]] = middle
            self.held += 200
            node, at = middle, at + same
        if self.held > self.budget:
            self._spill()

    @staticmethod
    def _walk(node: list, prefix: bytes) -> Iterator[tuple[bytes, list]]:
        todo = [(node, prefix)]
        while todo:
            here, path = todo.pop()
            yield path, here
            todo += [(kid, path + kid[_LABEL]) for kid in here[_KIDS].values()]

    def _spill(self) -> None:
        """Moves the heaviest subtree below the root that is still in memory to a file."""
        def weight(node: list) -> int:
            return sum(len(x[_LABEL]) + 200 for _, x in self._walk(node, b"") if x[_FILE] is None)

        kids = [(weight(kid), byte) for byte, kid in self.root[_KIDS].items() if kid[_FILE] is None]
        if not kids:
            return
        heaviest, byte = max(kids)
        top = self.root[_KIDS][byte]
        out = tempfile.TemporaryFile()
        for path, node in self._walk(top, b""):
            if node[_ENTRY] is not None:
                pickle.dump((path, *node[_ENTRY]), out, protocol=5)
            if node[_FILE] is not None:  # an earlier spill below: its records move up with their path
                for suffix, *entry in _records(node[_FILE]):
                    pickle.dump((path + suffix, *entry), out, protocol=5)
        top[_KIDS], top[_ENTRY], top[_FILE] = {}, None, out
        self.held -= heaviest

    def entries(self) -> Iterator[tuple[bytes, list]]:
        """(text, [identifier, rows, payload]) of every distinct text; spilled subtrees follow, one at a time."""
        spilled = []
        for path, node in self._walk(self.root, b""):
            if node[_ENTRY] is not None:
                yield path, node[_ENTRY]
            if node[_FILE] is not None:
                spilled.append((path, node[_FILE]))
        self.root, self.held = [b"", {}, None, None], 0
        for path, file in spilled:
            inner = PatriciaOwners(self.budget, self.largest)
            for record in _records(file):
                inner.insert(*record)
            for suffix, entry in inner.entries():
                yield path + suffix, entry


def _records(file) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            file.close()
            return


_TEXTS = "length int, sha binary, text binary, keep_id bigint, group_size bigint"
_OWNERS = "length int, sha binary, keep_id bigint, group_size bigint"


def _out(rows: Iterable[tuple[bytes, list]], with_text: bool) -> Iterator[pa.RecordBatch]:
    def batch(part: list) -> pa.RecordBatch:
        arrays = {"length": pa.array([e[2][0] for _, e in part], pa.int32())}
        arrays["sha"] = pa.array([e[2][1] for _, e in part], pa.binary())
        if with_text:
            arrays["text"] = pa.array([t for t, _ in part], pa.binary())
        arrays["keep_id"] = pa.array([e[0] for _, e in part], pa.int64())
        arrays["group_size"] = pa.array([e[1] for _, e in part], pa.int64())
        return pa.RecordBatch.from_pydict(arrays)

    part, held = [], 0
    for row in rows:
        part.append(row)
        held += len(row[0])
        if len(part) >= 4096 or held > 4 << 20:
            yield batch(part)
            part, held = [], 0
    if part:
        yield batch(part)


def _merger(budget: int, largest: bool, before_shuffle: bool, with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaOwners(budget, largest)
        for b in batches:
            lengths, shas, texts, keeps, rows = (b.column(i) for i in range(5))
            for i in range(b.num_rows):
                trie.insert(texts[i].as_py(), keeps[i].as_py(), rows[i].as_py(), (lengths[i].as_py(), shas[i].as_py()))
                if before_shuffle and trie.held > budget // 2:  # a partial merge may be cut anywhere
                    yield from _out(trie.entries(), True)
        yield from _out(trie.entries(), before_shuffle or with_text)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, normalise: Column | None = None, keep: str = "largest", budget_bytes: int = 64 << 20, digest_bytes: int = 32) -> DataFrame:
    """Group of equal texts for every row: (id_col, keep_id, group_size, kept, text_sha256).

    Texts are equal when their normalised forms (A-Z lower-cased; null counts as empty) have the same bytes.
    keep is "largest" or "smallest" identifier. Rows whose identifier is null count in group_size and are never
    kept; a group of such rows only has a null keep_id. A repeated row (same identifier and text) is reported as often as
    it occurs, each time with the same decision. An empty table gives an empty result. Other columns are ignored.
    digest_bytes of the SHA-256 are used; the result is the same for any number.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    norm = ascii_lower(F.col(text_col)) if normalise is None else normalise
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), norm.alias("norm"))
    keyed = base.select("id", F.octet_length("norm").alias("bytes"), F.unhex(F.sha2("norm", 256)).alias("digest"), F.col("norm").cast("binary").alias("text"))
    short = F.substring("digest", 1, digest_bytes)
    rows = keyed.select(F.col("bytes").alias("length"), short.alias("sha"), "text", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    largest = keep == "largest"
    merged = rows.mapInArrow(_merger(budget_bytes, largest, True), _TEXTS)
    owners = persisted(merged.repartition("length", "sha").mapInArrow(_merger(budget_bytes, largest, False), _OWNERS))
    narrow = persisted(keyed.select("id", "bytes", "digest"))  # read twice below
    total = owners.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    same = lambda x: (F.col("bytes") == x["length"]) & (short == x["sha"])
    counted = owners.withColumn("n", F.col("group_size"))
    # Digests of which a trie holds several texts.
    clashes = persisted(owners.groupBy("length", "sha").agg(F.count("*").alias("texts")).where(F.col("texts") > 1).select("length", "sha"))
    if clashes.isEmpty():
        out = join_counted(narrow, counted, same, total)
    else:
        out = join_counted(narrow.join(clashes, same(clashes), "left_anti"), counted.join(clashes, ["length", "sha"], "left_anti"), same, total)
        texts = merged.join(clashes, ["length", "sha"], "left_semi").select("length", "sha", "text", "keep_id", "group_size")
        texts = persisted(texts.repartition("length", "sha").mapInArrow(_merger(budget_bytes, largest, False, True), _TEXTS)).withColumnRenamed("text", "owned").withColumn("n", F.col("group_size"))
        by_text = join_counted(keyed.join(clashes, same(clashes), "left_semi"), texts, lambda x: same(x) & (F.col("text") == x["owned"]), total)
        out = out.select("id", "digest", "keep_id", "group_size").unionByName(by_text.select("id", "digest", "keep_id", "group_size"))
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
