"""Sharding by histogram sort, so that shards hold nearly equal bytes.

Rows are ordered by a key of their text and, where copies of one text make up
more than ``TOLERANCE`` of a shard, by a key of their id as well: such a group
may be cut, any other stays whole. Splitter i is the first element of that order
with i/shards of all bytes before it. It is found by probing: the bytes below
evenly spaced key boundaries are counted exactly, over all partitions, and only
the ranges that hold an open splitter are probed more finely, until such a range
holds a single element. Then the rows are exchanged once, to the cells of their
shards, where prefix sums over the cells give every row its place.

Defined results: the size of a row is its text's UTF-8 bytes and ``ROW_BYTES``;
null is the empty text; rows that repeat id and text stay together; rows with a
null id are ordered as if it were the empty string; with fewer elements than
shards some shards are empty; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightrank.llm.text import fresh_name, numbered
from flightrank.session import written_once

SHARDS = 24
ROW_BYTES = 8
TOLERANCE_PERCENT = 1
KEY_BITS = 60
PROBE_BITS = 10  # 2**PROBE_BITS probes in each range at a time
CELL_BYTES = 16 << 20

Splitter = tuple[int, int]


def _key(value: Column) -> Column:
    """The first 60 bits of the SHA-256 digest."""
    return F.conv(F.substring(F.sha2(value, 256), 1, KEY_BITS // 4), 16, 10).cast("long")


def text_key(text: Column) -> Column:
    return _key(F.coalesce(text, F.lit("")))


def id_key(doc_id: Column) -> Column:
    return _key(F.coalesce(doc_id.cast("string"), F.lit("")))


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _probe(keys: DataFrame, key: str, open_at: dict[int, list[int]], bits: int, before: dict[int, int], parts: int, total: int):
    """One round: the splitters of each open range, told apart by the range's finer parts.

    ``open_at``: of each range (its key without the last ``bits`` bits) the open
    splitters; ``before``: the bytes before it. Returns the same for the next
    round, and the element's key where a range holds just one.
    """
    step = min(PROBE_BITS, bits)
    inside = keys.filter(F.shiftright(key, bits).isin(list(open_at)))
    counted = (
        inside.groupBy(F.shiftright(key, bits - step).alias("part"))
        .agg(F.sum("size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()  # at most 2**PROBE_BITS rows for each of the splitters
    )
    ranges = defaultdict(list)
    for part, size, low, high in sorted(tuple(r) for r in counted):
        ranges[part >> step].append((part, size, low, high))
    next_open, next_before, single = defaultdict(list), {}, {}
    for at, splitters in open_at.items():
        for i in splitters:
            below = before[at]
            for part, size, low, high in ranges[at]:
                if below * parts >= i * total:  # the splitter is where this part starts
                    single[i] = (low, below, True)
                    break
                if (below + size) * parts > i * total or (part, size, low, high) == ranges[at][-1]:
                    if low == high:
                        single[i] = (low, below, False)
                    else:
                        next_open[part].append(i)
                        next_before[part] = below
                    break
                below += size
    return next_open, next_before, single


def _search(keys: DataFrame, key: str, wanted: list[int], start: int, parts: int, total: int) -> dict[int, tuple[int, int, bool]]:
    """Of each wanted splitter the key it lies at, the bytes before that key, and
    whether it is the start of that key (else it is inside or just after it)."""
    open_at, before, bits, found = {0: wanted}, {0: start}, KEY_BITS, {}
    while open_at:
        open_at, before, single = _probe(keys, key, open_at, bits, before, parts, total)
        found |= single
        bits -= min(PROBE_BITS, bits)
    return found


def splitters(keys: DataFrame, shards: int, total: int, large: list[int]) -> list[Splitter]:
    """The first ``(text key, id key)`` of each shard after the first.

    ``keys``: rows ``text_key, id_key, size``; ``large``: text keys of the groups
    that may be cut.
    """
    by_text = _search(keys, "text_key", list(range(1, shards)), 0, shards, total)
    out: dict[int, Splitter] = {}
    inside = defaultdict(list)
    for i, (key, below, at_start) in by_text.items():
        if at_start:
            out[i] = (key, 0)
        elif key in large:
            inside[key, below].append(i)
        else:
            out[i] = (key + 1, 0)
    for (key, below), wanted in inside.items():  # at most one search per splitter
        group = keys.filter(F.col("text_key") == key)
        for i, (by_id, _, at_start) in _search(group, "id_key", wanted, below, shards, total).items():
            out[i] = (key, by_id if at_start else by_id + 1)
    return [out[i] for i in range(1, shards)]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = SHARDS,
    tolerance_percent: int = TOLERANCE_PERCENT,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, a place without gaps in the shard."""
    names = {c: fresh_name(c, docs.columns) for c in ("text_key", "id_key", "size", "shard", "slot", "cell")}
    made = {
        names["text_key"]: text_key(F.col("text")),
        names["id_key"]: id_key(F.col("doc_id")),
        names["size"]: size_of(F.col("text")),
    }
    keys = written_once(
        docs.select(*[made[names[c]].alias(c) for c in ("text_key", "id_key", "size")]), "shard-keys"
    )
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Fewer than shards * 100 / tolerance_percent groups can be that large.
    groups = keys.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    large = groups.filter(F.col("bytes") * shards * 100 > F.lit(total) * tolerance_percent)
    large_keys = [r[0] for r in large.select("text_key").collect()]
    cuts = splitters(keys, shards, total, large_keys) if total else [(0, 0)] * (shards - 1)
    cells = max(1, -(-total // (shards * cell_bytes)))

    def placed(table: DataFrame, own: dict[str, str]) -> DataFrame:
        by_text, by_id = F.col(own["text_key"]), F.col(own["id_key"])
        past = [
            ((by_text > t) | ((by_text == t) & (by_id >= i))).cast("int") if i else (by_text >= t).cast("int")
            for t, i in cuts
        ]
        shard = sum(past[1:], past[0]) if past else F.lit(0)
        return table.withColumn(own["shard"], shard).withColumn(
            own["cell"], F.pmod(by_text.bitwiseXOR(by_id), F.lit(cells))
        )

    plain = {c: c for c in names}
    counts = placed(keys, plain).groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumnsRenamed({c: names[c] for c in ("shard", "cell")})
    order = [names["text_key"], names["id_key"]]
    out = numbered(
        placed(docs.withColumns(made), names), names["shard"], names["cell"], order, names["slot"], counts
    )
    return out.select(*docs.columns, *[names[c] for c in ("size", "shard", "slot")])
