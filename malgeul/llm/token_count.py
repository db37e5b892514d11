"""Token counts without ids: pieces are counted once per distinct pre-token and joined to the
pre-token frequencies of each document.

The vocabulary of the corpus is one aggregation.  Pre-tokens in many documents, at most
``HOT`` of them with ``HOT_CHARS`` characters in all, are broadcast, so no common word becomes a
hot join key; the others are joined by a shuffle as postings of a block of documents.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from malgeul.llm.common import materialize, require

#: Pre-tokens that are broadcast at most, their characters in all, and those of one.
HOT, HOT_CHARS, LONGEST = 400_000, 16_000_000, 100_000
#: Bytes of text whose postings are gathered at once, and distinct pre-tokens held before they are passed on.
BLOCK, HELD = 4_000_000, 1_000_000


class WordPretokens:
    """Pre-tokens of a lower-casing word BPE file of the ``tokenizers`` library: NFC, lower case and
    the file's split pattern; strings of special tokens are found first, as the library does."""

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"

    def __init__(self, specials: list[str]):
        self.wide, self.narrow = regex.compile(self.SPLIT), re.compile(self.ASCII, re.ASCII)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None

    def __call__(self, text: str) -> list[str]:
        if self.specials and self.specials.search(text):
            out = []
            for i, part in enumerate(self.specials.split(text)):
                out += [part] if i % 2 else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.narrow.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        return self.wide.findall(text.replace("Σ", "σ").lower())  # letter by letter: no final sigma


class WordTokenizer:
    """Counts pieces of pre-tokens with the ``tokenizers`` library; opened once per worker."""

    def __init__(self, content: str):
        import json

        self.content = content
        self.specials = [t["content"] for t in json.loads(content)["added_tokens"]]
        self.pretokens = WordPretokens(self.specials)

    def counter(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # else each thread of each worker holds memory of its own
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        whole = Tokenizer.from_str(self.content)
        whole.normalizer = normalizers.Sequence([])
        whole.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return lambda tokens: [len(whole.encode(t, add_special_tokens=False).ids) for t in tokens]

    def __getstate__(self):
        return {"content": self.content}

    def __setstate__(self, state):
        self.__init__(state["content"])


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with about BLOCK bytes."""
    first, texts, size = 0, [], 0
    for i, text in enumerate(batch["text"]):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= BLOCK:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def vocabulary(docs: DataFrame, tokenizer: WordTokenizer) -> DataFrame:
    """``pretoken``, ``n_docs`` (at least; repeats of a text within a block count) and ``pieces`` of every distinct pre-token."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = shared.value.pretokens, Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["pretoken", "n_docs"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch["text"]:
                seen.update(set(split(text.as_py() or "")))
                if len(seen) >= HELD:
                    yield out()
        yield out()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.counter()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["pretoken"], batch["n_docs"], pa.array(pieces(batch["pretoken"].to_pylist()), pa.int64())], ["pretoken", "n_docs", "pieces"])

    seen = docs.select("text").mapInArrow(distinct, "pretoken string, n_docs long")
    return seen.groupBy("pretoken").agg(F.sum("n_docs").alias("n_docs")).mapInArrow(count, "pretoken string, n_docs long, pieces long")


def _hot(vocab: DataFrame) -> dict[str, int]:
    """Pieces of the pre-tokens in most documents: as many whole classes of equal log2(n_docs) as fit."""
    some = vocab.withColumn("chars", F.length("pretoken")).filter(F.col("chars") <= LONGEST).withColumn("class", F.floor(F.log2("n_docs")))
    total, chars, least = 0, 0, None
    for row in sorted(some.groupBy("class").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect(), key=lambda r: -r["class"]):  # at most 63 rows
        total, chars = total + row["n"], chars + row["chars"]
        if total > HOT or chars > HOT_CHARS:
            break
        least = row["class"]
    if least is None:
        return {}
    return {r["pretoken"]: r["pieces"] for r in some.filter(F.col("class") >= least).select("pretoken", "pieces").toLocalIterator()}


def count_tokens(docs: DataFrame, tokenizer: WordTokenizer) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes`` and ``n_tokens`` of its whole ``text``.

    Null and empty texts have 0 of both; repeated rows and null ids are counted row by row; other
    columns are ignored; an empty table gives no rows.
    """
    require(docs, "doc_id", "text")
    sc = docs.sparkSession.sparkContext
    vocab = materialize(vocabulary(docs, tokenizer), "vocabulary")
    shared, hot = sc.broadcast(tokenizer), sc.broadcast(_hot(vocab))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document with the pieces of hot pre-tokens, and postings of the others."""
        split, known = shared.value.pretokens, hot.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, texts in _blocks(batch):
                sums, rare = [], {}
                for i, text in enumerate(texts):
                    total = 0
                    for token, times in Counter(split(text)).items():
                        if (pieces := known.get(token)) is not None:
                            total += pieces * times
                        else:
                            rare.setdefault(token, []).append((i, times))
                    sums.append(total)
                n, m = len(texts), len(rare)
                keys = pa.array([f"\0{row + i}" for i in range(n)], pa.string())
                ids = batch["doc_id"].slice(first, n)
                posts = list(rare.values())
                at = np.cumsum([0, *map(len, posts)], dtype=np.int32)
                flat = np.array([p for own in posts for p in own], np.int64).reshape(-1, 2)
                none = np.zeros(n + 1, np.int32)
                empty = lambda: pa.ListArray.from_arrays(none, np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(range(row, row + n), pa.int64()), ids, pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(sums, pa.int64()), empty(), empty()], NAMES
                )
                if m:
                    null = lambda kind: pa.nulls(m, kind)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rare, pa.string()), pa.array(np.full(m, row)), null(ids.type), null(pa.int64()), null(pa.int64()), pa.ListArray.from_arrays(at, flat[:, 0].astype(np.int32)), pa.ListArray.from_arrays(at, flat[:, 1].astype(np.int32))], NAMES
                    )
                row += n

    NAMES = ["pretoken", "row", "doc_id", "n_bytes", "hot", "places", "times"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(frequencies, f"pretoken string, row long, doc_id {kind}, n_bytes long, hot long, places array<int>, times array<int>")
    cold = vocab.select("pretoken", "pieces")
    joined = made.join(cold, "pretoken", "left")  # the key of a document's own row meets no pre-token
    sums = joined.select(
        "doc_id", "n_bytes", "hot", F.col("row"), "pieces", F.explode_outer(F.arrays_zip("places", "times")).alias("p")
    ).select(
        (F.col("row") + F.coalesce("p.places", F.lit(0))).alias("row"), "doc_id", "n_bytes",
        F.coalesce("hot", F.col("pieces") * F.col("p.times")).alias("tokens"),
    )
    return (
        sums.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").cast("long").alias("n_tokens"))
        .drop("row")
    )
