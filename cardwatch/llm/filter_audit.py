"""How filters of a corpus overlap: for every order of them, what each removes, repeats, and costs in good documents.

Four filters look at one text; the fifth asks whether a smaller id has the same text. Identical texts meet in compressed tries, at
whose terminals the smallest id stands. Every task first puts its own texts into a trie, so that of a text's copies in one task
only one goes on. Those that go on are dealt out by ranges of text prefixes; a prefix that too many bytes of text share is
replaced by a longer one. Each prefix has a trie of its own, which is traversed for the rows that are not the smallest.
Then all that is left of a document is a mask of the filters it fails, and masks are counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import write_once

FILTERS = "ABCDE"
_BITS = {name: 1 << i for i, name in enumerate(FILTERS)}
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = re.compile(rb"[#$%&*|]")

#: A task's trie is emptied when it holds this many bytes of distinct texts.
FLUSH_BYTES = 16 << 20
#: A prefix that more bytes of text share, or more than a quarter of a task's part of them, is made longer.
PREFIX_BYTES = 16 << 20
#: Lengths of prefixes, in characters. Texts alike beyond the last are told apart by a digest of the whole text.
PREFIXES = (32, 128, 512)


class Node:
    __slots__ = ("label", "children", "least", "owner", "rows")

    def __init__(self, label: bytes):
        self.label, self.children = label, {}
        #: At a terminal: the smallest id, the row that has it, and all rows.
        self.least = self.owner = None
        self.rows: list = []


class Trie:
    """A compressed trie over byte strings. ``n_bytes`` counts the labels' bytes."""

    def __init__(self) -> None:
        self.root, self.n_bytes = Node(b""), 0

    def at(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if it is not there."""
        node, pos = self.root, 0
        while pos < len(text):
            child = node.children.get(text[pos])
            if child is None:
                child = node.children[text[pos]] = Node(text[pos:])
                self.n_bytes += len(text) - pos
                return child
            label = child.label
            if not text.startswith(label, pos):
                low = _alike(label, text, pos)
                middle = Node(label[:low])
                middle.children[label[low]] = child
                child.label = label[low:]
                node.children[text[pos]] = middle
                child, label = middle, middle.label
            node, pos = child, pos + len(label)
        return node

    def put(self, text: bytes, doc_id, row) -> Node:
        node = self.at(text)
        if node.owner is None or doc_id < node.least:
            node.least, node.owner = doc_id, row
        return node

    def terminals(self) -> Iterator[Node]:
        held = [self.root]
        while held:
            node = held.pop()
            held += node.children.values()
            if node.owner is not None:
                yield node


def _alike(label: bytes, text: bytes, pos: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``pos`` on."""
    low, high = 0, min(len(label), len(text) - pos)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == text[pos + low : pos + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def failed_by_text(text: str, raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # ASCII white space only
    n = len(words)
    mask = _BITS["A"] * (n < 50)
    mask |= _BITS["B"] * (100 * len(set(words)) < 65 * n)
    mask |= _BITS["C"] * (100 * (len(raw) - len(raw.translate(None, _UPPER))) > 5 * len(text))
    mask |= _BITS["D"] * (_MARKS.search(raw) is not None)
    return mask


_JUDGED = "uid long, doc_id {kind}, part string, mask int, rep long, again boolean, octets long, text string"


def _judge(kind: pa.DataType):
    """Per row its mask, and its text if it stands for the copies in this task.

    ``rep``: the row that stands for this one; the row itself if its copies do not matter any more. ``again``: a smaller id with the
    same text is known.
    """
    names = [c.split()[0] for c in _JUDGED.split(", ")]
    kinds = [pa.int64(), kind, pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]

    def flushed(rows: list) -> pa.RecordBatch:
        out = []
        for uid, doc_id, part, mask, text, size, node in rows:
            again = node is not None and doc_id > node.least
            stands = node is not None and node.owner == uid
            own = node is None or again
            out.append((uid, doc_id, part, mask, uid if own else node.owner, again, size, text if stands else None))
        columns = zip(*out) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows, held = Trie(), [], 0
        for uid, doc_id, part, text in (
            row for b in batches for at in range(0, b.num_rows, 64) for row in zip(*[c.to_pylist() for c in b.slice(at, 64).columns])
        ):
            raw = text.encode()
            mask = failed_by_text(text, raw)
            node = None
            if doc_id is not None:
                before = trie.n_bytes
                node = trie.put(raw, doc_id, uid)
                # A text seen before is not held a second time.
                if trie.n_bytes == before and node.rows:
                    text = node.rows[0]
                else:
                    node.rows.append(text)
                    held += len(raw)
            rows.append((uid, doc_id, part, mask, text if node is not None else None, len(raw), node))
            if held + 200 * len(rows) > FLUSH_BYTES:
                yield flushed(rows)
                trie, rows, held = Trie(), [], 0
        yield flushed(rows)

    return judge


def with_prefixes(texts: DataFrame, most_bytes: int, lengths: tuple[int, ...] = PREFIXES) -> DataFrame:
    """Add ``prefix``, equal for equal texts: the shortest of the given lengths that no more than ``most_bytes`` of text share.

    ``texts`` (uid, doc_id, octets, text), stored. Each length beyond the first is tried only where it is needed, and what is too
    often shared is a table of its own, which Spark broadcasts only if it is small.
    """
    prefix = lambda n: F.substring("text", 1, n)
    keyed = texts.withColumn("prefix", prefix(lengths[0])).withColumn("open", F.lit(True))
    for longer in (*lengths[1:], None):
        sizes = keyed.filter("open").groupBy("prefix").agg(F.sum("octets").alias("shared"))
        crowded = write_once(sizes.filter(F.col("shared") > most_bytes).select("prefix", F.lit(True).alias("crowded")), "prefixes")
        if crowded.isEmpty():
            break
        whole = F.concat("prefix", F.sha2("text", 256)) if longer is None else prefix(longer)
        more = F.col("open") & F.col("crowded").isNotNull()
        keyed = keyed.join(crowded, "prefix", "left").withColumns({"prefix": F.when(more, whole).otherwise(F.col("prefix")), "open": more})
        keyed = keyed.drop("crowded")
    return keyed.drop("open")


def _not_smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix: per prefix a trie, from which come the rows that are not the smallest of their text."""

    def found(trie: Trie) -> pa.RecordBatch:
        late = [uid for node in trie.terminals() for uid, doc_id in node.rows if doc_id > node.least]
        return pa.RecordBatch.from_arrays([pa.array(late, pa.int64())], ["rep"])

    trie, current = Trie(), None
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for prefix, uid, doc_id, text in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]):
                if prefix != current:
                    yield found(trie)
                    trie, current = Trie(), prefix
                trie.put(text.encode(), doc_id, uid).rows.append((uid, doc_id))
    yield found(trie)


def failure_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, part, mask (bits of the filters it fails, A lowest)."""
    columns = [
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    ]
    rows = docs.select(*columns)
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    judged = write_once(rows.mapInArrow(_judge(to_arrow_type(kind)), _JUDGED.format(kind=kind.simpleString())), "judged", "zstd")
    standing = judged.filter(F.col("text").isNotNull()).select("uid", "doc_id", "octets", "text")
    n_bytes = judged.filter(F.col("text").isNotNull()).agg(F.sum("octets")).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // PREFIX_BYTES + 1)
    dealt = with_prefixes(standing, min(PREFIX_BYTES, n_bytes // (4 * tasks) + 1)).select("prefix", "uid", "doc_id", "text")
    dealt = dealt.repartitionByRange(tasks, "prefix").sortWithinPartitions("prefix")
    late = dealt.mapInArrow(_not_smallest, "rep long").withColumn("late", F.lit(True))
    again = F.col("again") | F.col("late").isNotNull()
    met = judged.select("doc_id", "part", "mask", "rep", "again").join(late, "rep", "left")
    return met.select("doc_id", "part", F.when(again, F.col("mask").bitwiseOR(_BITS["E"])).otherwise(F.col("mask")).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, *, label_id: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows per part. Rows of one id are counted before they meet its label."""
    by_id = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    flags = labels.groupBy(F.col(label_id).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    met = by_id.join(flags.filter("good = 1 OR toxic = 1"), "doc_id", "left")
    marked = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(0)).alias(flag)
    return met.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("good"), marked("toxic"))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    label_id: str = "doc_id",
) -> DataFrame:
    """Every order of five filters, step by step, per part of a corpus.

    A text fails A with under 50 words, B if under 65 % of its words are distinct, C if over 5 % of its characters are A-Z, D if it
    holds any of ``#$%&*|``, E if it is the text of a smaller id anywhere in the table. Words stand between blanks.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows per part,
    where each filter only sees what those before it left, and ``shapley`` is what a step's filter removes, summed over all orders.

    A null text counts as empty, a null part as the empty one. A null id is neither smaller nor larger than any and has no label. Rows
    with the same id and text are no duplicates of each other; repeated labels count once, positive if one of them is. Other
    columns are ignored, whatever their names; an empty table gives an empty result. ``docs`` is scanned once.
    """
    counts = mask_counts(failure_masks(docs, id_col=id_col, text_col=text_col, part_col=part_col), labels, label_id=label_id)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {name: F.locate(name, F.col("filter_order")) for name in FILTERS}

    def bits(holds) -> Column:
        return sum((F.when(holds(place[name]), bit).otherwise(0) for name, bit in _BITS.items()), F.lit(0))

    steps = steps.withColumns({"own": bits(lambda p: p == F.col("step")), "before": bits(lambda p: p < F.col("step"))})

    def total(holds, value=lambda m: m["n"]) -> Column:
        return F.aggregate(F.filter("masks", holds), F.lit(0).cast("long"), lambda s, m: s + value(m))

    fails = lambda m: m["mask"].bitwiseAND(F.col("own")) != 0
    passed = lambda m: m["mask"].bitwiseAND(F.col("before")) == 0
    removed = lambda m: fails(m) & passed(m)
    n_orders = len(list(permutations(FILTERS)))
    # Of the filters that a document fails, each is the first one in as many orders as any other.
    share = lambda m: F.expr(f"{n_orders}L") * m["n"] / F.bit_count(m["mask"])
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: ~fails(m) & passed(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & ~passed(m)).alias("redundant"),
        total(lambda m: m["mask"] == F.col("own")).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(fails, lambda m: share(m).cast("long")).alias("shapley"),
    )
