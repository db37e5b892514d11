"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, its source's target over its
source's size.  Whole copies are certain; the fraction is rounded at random, but not
independently: two documents meet, and words of probability pass from one to the other until one
of them is sure to be in or out.  The other meets the next one.  Thus the expected words of a
source never change, and each step settles one document.

Leaves of at most about ``LEAF`` documents settle all but one of theirs; what is left meets in a tree with
``FAN`` children to a node.  Small documents are kept for a second pass: the large document
that the first one leaves is settled against all their words at once, so that a source
ends within about one small document of its target.  All draws are hashes of the seed
and of the document, so reruns agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from malgeul.llm.common import discard, materialize, require, unused

LEAF, FAN = 4_000, 64
EPSILON = 1e-12
#: Decisions that are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows: ``share`` of all words dealt by weight, no
    source over ``most`` times its size, what is over dealt anew by weight among the others.

    Weights repeat over the sources by code point, null last.  The share that water-filling ends
    with is found by sorting: in order of size over weight, a source is full as long as the even share of
    what is left would be over its limit."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    named = own.withColumn("place", F.row_number().over(place) - 1)
    named = named.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)).withColumn("limit", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.partitionBy()
    named = (
        named.withColumn("budget", share * F.sum("source_size").over(total))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    )
    level = F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("ratio"), "place", "level"))).over(total)["level"]
    return named.select("source", "source_size", F.coalesce(F.least(level * F.col("weight"), F.col("limit")), F.col("limit")).alias("target"))


def _draw(*parts) -> float:
    raw = hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=8).digest()
    return (int.from_bytes(raw, "big") >> 11) / (1 << 53)


def settle(rows: list[tuple[int, float]], draw) -> tuple[list[float], int | None]:
    """Round (size, probability) rows in order.  Returns the probabilities, all 0 or 1 but for at most
    one, and the place of that one.  ``draw(i, j)`` gives a number in [0, 1)."""
    p = [q if s > 0 else 0.0 for s, q in rows]  # no words: nothing to take
    i: int | None = None
    for j, (s, _) in enumerate(rows):
        if not 0.0 < p[j] < 1.0:
            continue
        if i is None:
            i = j
            continue
        r = rows[i][0]
        gain, loss = min(r * (1 - p[i]), s * p[j]), min(r * p[i], s * (1 - p[j]))  # words that i can get from j, or give
        if draw(i, j) < loss / (gain + loss):
            full = gain == r * (1 - p[i])
            p[i], p[j] = (1.0, p[j] - gain / s) if full else (p[i] + gain / r, 0.0)
        else:
            full = loss == r * p[i]
            p[i], p[j] = (0.0, p[j] + loss / s) if full else (p[i] - loss / r, 1.0)
        i = j if full else i
        if not EPSILON < p[i] < 1 - EPSILON:
            p[i], i = float(round(p[i])), None
    return p, i


_NAMES = ["doc_id", "source", "size", "p", "node", "nth", "open"]


def _round(rows: DataFrame, seed: int, kind: str, level: str) -> DataFrame:
    """Settle each (source, node), large documents first; ``open`` marks what each leaves."""

    def run(group: pa.Table) -> pa.Table:
        own = sorted(group.select(_NAMES).to_pylist(), key=lambda r: (-r["size"], r["doc_id"] is not None, r["doc_id"], r["nth"]))
        name = [(r["doc_id"], r["nth"]) for r in own]
        p, left = settle([(r["size"], r["p"]) for r in own], lambda i, j: _draw(seed, level, *name[i], *name[j]))
        for i, r in enumerate(own):
            r["p"], r["open"] = p[i], i == left
        return pa.Table.from_pylist(own, group.select(_NAMES).schema)

    schema = f"doc_id {kind}, source string, size long, p double, node long, nth int, open boolean"
    return rows.select(*_NAMES).groupBy("source", "node").applyInArrow(run, schema)


def _tree(rows: DataFrame, leaves: int, seed: int, kind: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled rows, at most one open row for each source) of rows whose ``node`` is their leaf."""
    done, level = [], 0
    while True:
        rows = materialize(_round(rows, seed, kind, f"{name}{level}"), "mixture")
        left = rows.filter("open")
        done.append(rows.filter("not open"))
        if leaves <= 1:
            break
        leaves, level = -(-leaves // FAN), level + 1
        rows = left.withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
    settled = done[0]
    for d in done[1:]:
        settled = settled.unionByName(d)
    return settled, left


def _thresholds(rows: DataFrame) -> DataFrame:
    """``source, small``: documents under ``small`` words, a power of two, are kept for the second pass.  Their
    words suffice to take up the largest document of the source whole, in or out; where those of no class below
    its own do, all of these are kept."""
    classes = rows.groupBy("source", F.floor(F.log2("size")).alias("class")).agg(F.sum("size").alias("words"), F.max("size").alias("largest"), F.first("p").alias("p"))
    w = Window.partitionBy("source")
    upto = (
        classes.withColumn("upto", F.sum("words").over(w.orderBy("class")))
        .withColumn("need", F.max("largest").over(w) / F.least(F.col("p"), 1 - F.col("p")))
        .withColumn("top", F.max("class").over(w))
    )
    enough = F.min(F.when(F.col("upto") >= F.col("need"), F.col("class")))
    return upto.groupBy("source").agg(F.pow(F.lit(2.0), F.least(F.coalesce(enough + 1, F.max("top")), F.max("top"))).cast("long").alias("small"))


def _settle_against_pool(left: DataFrame, pool: DataFrame, seed: int) -> DataFrame:
    """Settle what the first pass has left of each source against its small documents as one: ``own`` (the source), ``p_left, p_pool``."""
    words = pool.groupBy("source").agg(F.sum("size").alias("words"), F.first("p").alias("q"))
    rows = left.select(F.col("source").alias("own"), "doc_id", "nth", "size", "p")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.to_pylist()
            pairs = [settle([(r["size"], r["p"]), (r["words"], r["q"])], lambda *_: _draw(seed, "pool", r["doc_id"], r["nth"]))[0] for r in own]  # noqa: B023
            yield pa.RecordBatch.from_arrays([batch["own"], *(pa.array([p[k] for p in pairs], pa.float64()) for k in (0, 1))], ["own", "p_left", "p_pool"])

    met = rows.join(words, F.col("own").eqNullSafe(F.col("source"))).drop("source")
    return met.mapInArrow(run, "own string, p_left double, p_pool double")


def mix(docs: DataFrame, seed: int = 11, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: ``doc_id, source, nth, size, source_size, target, copies, taken``.

    ``copies`` is a whole number with the mean target / source_size, ``taken`` the words of all copies.
    Null and empty texts have size 0 and 0 copies, as have documents of a source without words; null is a
    source.  Rows with one doc_id, source and size are told apart by ``nth``, and each is decided by itself.
    Other columns are ignored; an empty table gives no rows.
    """
    require(docs, "doc_id", "text", "source")
    kind = docs.schema["doc_id"].dataType.simpleString()
    sizes = materialize(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    aims = materialize(targets(sizes, share, most, weights), "targets")
    # equal rows are numbered after they have been counted, so that many of them are no more than one row in the shuffle
    times = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").cast("int").alias("times"))
    rows = materialize(times.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")), "numbered")
    discard(sizes)
    aim = aims.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumnRenamed("source", "own")
    same = F.col("source").eqNullSafe(F.col("own"))
    rates = aim.select("own", "rate", F.floor("rate").alias("whole"))
    rows = rows.join(rates, same).drop("own").withColumn("p", F.col("rate") - F.col("whole"))
    fraction = rows.filter("p > 0 and size > 0").select("doc_id", "source", "size", "p", "nth", F.lit(False).alias("open"))
    small = _thresholds(fraction).withColumnRenamed("source", "own")
    fraction = fraction.join(small, same).drop("own")
    counts = fraction.groupBy("source").count()
    leaves = -(-(counts.agg(F.max("count")).first()[0] or 1) // LEAF)
    # a source of n documents has ceil(n / LEAF) leaves
    node = counts.select(F.col("source").alias("own"), F.ceil(F.col("count") / LEAF).alias("leaves"))
    dealt = fraction.join(node, same).drop("own").withColumn("node", F.pmod(F.xxhash64("doc_id", "nth", F.lit(seed)), "leaves")).drop("leaves")
    dealt = materialize(dealt, "mixture")
    in_pool = F.coalesce(F.col("size") < F.col("small"), F.lit(False))
    first, left = _tree(dealt.filter(~in_pool).drop("small"), leaves, seed, kind, "large")
    pool = dealt.filter(in_pool).drop("small")
    against = materialize(_settle_against_pool(left, pool, seed), "mixture")
    pool = pool.join(against.select("own", "p_pool"), same, "left").withColumn("p", F.coalesce("p_pool", "p")).drop("own", "p_pool")
    second, last = _tree(pool, leaves, seed, kind, "small")
    left = left.join(against.select("own", "p_left"), same, "left").withColumn("p", F.coalesce("p_left", "p")).drop("own", "p_left")
    # what is still open takes its last draw alone
    draw = F.pmod(F.xxhash64("doc_id", "nth", F.lit(seed), F.lit("last")), F.lit(1 << 53)) / float(1 << 53)
    alone = left.unionByName(last).withColumn("p", F.when(F.col("p") >= 1, 1.0).when(F.col("p") <= 0, 0.0).when(draw < F.col("p"), 1.0).otherwise(0.0))
    settled = first.unionByName(second).unionByName(alone).select("doc_id", "source", "size", "nth", F.round("p").cast("long").alias("more"))
    out = settled.unionByName(rows.filter("not (p > 0 and size > 0)").select("doc_id", "source", "size", "nth", F.lit(0).cast("long").alias("more")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(0)
    aim = aim.withColumn("whole", F.floor("rate"))
    return (
        out.join(aim, same)
        .select("doc_id", "source", "nth", "size", "source_size", F.col("target").cast("double").alias("target"), copies.cast("long").alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def apply_mix(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``decisions`` of ``mix(docs)`` says, with the columns of ``docs``, of any name.

    A row is found by its doc_id, or where that is repeated or null, by doc_id, source and size, and rows that share these too
    by their place in order of text.  Rows with 0 copies go; an empty table gives no rows.
    """
    require(docs, "doc_id", "text", "source")
    names = own_id, own_source, own_size, own_nth, copies, times = [unused(docs, c) for c in ("own_id", "own_source", "own_size", "own_nth", "copies", "times")]
    told = materialize(decisions.select("doc_id", "source", "size", "nth", "copies"), "decisions")
    odd = materialize(told.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select(F.col("doc_id").alias(own_id)), "odd")
    n_odd, n = odd.count(), told.count()

    def hint(rows: DataFrame, size: int) -> DataFrame:
        return F.broadcast(rows) if size <= BROADCAST_ROWS else rows

    told = told.toDF(own_id, own_source, own_size, own_nth, copies)
    by_id = F.col("doc_id").eqNullSafe(F.col(own_id))
    plain = told if not n_odd else told.join(odd, told[own_id].eqNullSafe(odd[own_id]), "left_anti")
    met = docs.join(hint(plain.select(own_id, copies), n), by_id)
    out = met.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).select(*docs.columns)
    if not n_odd:
        return out
    rows = docs.join(hint(odd, n_odd), by_id, "left_semi").withColumn(own_size, size_of(F.col("text")))
    place = Window.partitionBy("doc_id", "source", own_size).orderBy(F.xxhash64("text"), "text")
    rows = rows.withColumn(own_nth, F.row_number().over(place))
    theirs = told.join(odd, told[own_id].eqNullSafe(odd[own_id]), "left_semi").filter(F.col(copies) > 0)
    theirs = theirs.toDF(*(unused(rows, f"{c}_") for c in names[:4]), copies)
    same = [rows[c].eqNullSafe(theirs[t]) for c, t in zip(("doc_id", "source", own_size, own_nth), theirs.columns, strict=False)]
    more = rows.join(theirs, same[0] & same[1] & same[2] & same[3])
    return out.unionByName(more.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).select(*docs.columns))
