"""Benchmark decontamination by winnowed fingerprints.

A window is ``WINDOW`` consecutive words of a benchmark item (all words of a shorter item). Texts
are fingerprinted by winnowing: the hashes of all k-grams, and of each run of WINDOW - k + 1
of them only the smallest. A span of WINDOW words holds exactly one such run, so equal spans
keep an equal hash: every shared span is found. Runs of windows that keep the same hash are one
fingerprint. Fingerprints of documents are joined with those of the benchmark; hits are extended
to the windows that kept the hash, and these are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import small, words, written

WINDOW = 10
GRAM = 5
CHUNK = 64
#: Benchmarks with more fingerprints or windows than this are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def _grams(hashes: Column, k: int) -> Column:
    """Hash of the k-gram at each word, from the hashes of the words."""
    return F.transform(hashes, lambda x, i: F.xxhash64(
        F.lit(k), x, *[F.get(hashes, i + j) for j in range(1, k)]))


def _least(*cols: Column) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def _windows(df: DataFrame, keep: list[str], lengths: list[int], gram: int, once: bool,
             texts: bool = False) -> DataFrame:
    """One row per window of ``df._words``: ``keep``, _at, _len, _print (the smallest hash of its
    k-grams), with ``texts`` also _text; with ``once`` only the first of consecutive windows that
    keep the same hash. A text without words gives one row, _at null; the row _at = 0 is there for
    all others (_len null if no window starts there).

    Texts are cut into overlapping chunks of CHUNK windows first: exploding copies the row, so
    the columns beside the exploded one must be short however long the text is. Hashes are taken
    after that cut, as Spark would merge them into the lambda that slices them otherwise.
    """
    reach = max(lengths, default=1)
    ks = sorted({min(gram, n) for n in lengths})
    size = F.size("_words")

    def chunk(s: Column) -> Column:
        base = F.greatest(s - 1, F.lit(0))  # one word more, for the window before
        return F.struct(s.alias("s"), base.alias("base"),
                        F.slice("_words", base + 1, CHUNK + reach).alias("words"))

    rows = df.withColumn("_chunks", F.when(size > 0, F.transform(
        F.sequence(F.lit(0), size - 1, F.lit(CHUNK)), chunk)))
    rows = (rows.select(*keep, size.alias("_n"), F.explode_outer("_chunks").alias("_c"))
            .select(*keep, "_n", F.col("_c.s").alias("_s"), F.col("_c.base").alias("_base"),
                    F.transform("_c.words", lambda w: F.xxhash64(w)).alias("_h"),
                    *[F.col("_c.words").alias("_w")] * texts)
            .select(*keep, "_n", "_s", "_base", *["_w"] * texts,
                    *[_grams(F.col("_h"), k).alias(f"_g{k}") for k in ks])
            .select("*", F.explode_outer(F.sequence("_s", F.least(
                F.col("_s") + CHUNK, F.col("_n")) - 1)).alias("_at")))
    at, found = F.col("_at") - F.col("_base"), []
    for length in lengths:
        k = min(gram, length)
        grams = [F.get(f"_g{k}", at + j) for j in range(-1, length - k + 1)]
        there = F.col("_at") + length <= F.col("_n")
        if once:
            there = there & ((F.col("_at") == 0) | (_least(*grams[1:]) != _least(*grams[:-1])))
        found.append(F.struct(F.when(there, F.lit(length)).alias("len"),
                              _least(*grams[1:]).alias("print")))
    found = found or [F.lit(None).cast("struct<len:int,print:bigint>")]
    rows = rows.withColumn("_f", found[0] if len(found) == 1 else F.explode(F.array(*found)))
    text = [F.array_join(F.slice("_w", at + 1, F.col("_f.len")), " ").alias("_text")]
    return (rows.select(*keep, "_at", F.col("_f.len").alias("_len"),
                        F.col("_f.print").alias("_print"), *(text if texts else []))
            .where(F.col("_at").isNull() | (F.col("_at") == 0) | F.col("_len").isNotNull()))


def find_hits(docs: DataFrame, items: DataFrame, key: list[str], window: int = WINDOW,
              gram: int = GRAM) -> DataFrame:
    """One row per distinct ``key``: key, ``copies`` (rows of that key), ``n_words``, ``spans``
    (array of (s, e): the words s..e-1 of a hit window) and ``items`` (array of item ids).

    ``docs`` has the columns ``key`` and ``text``, ``items`` has item_id and text; rows of equal
    key must have equal texts. Null texts have no words; items without words have no window.
    """
    bench = items.select(F.col("item_id").cast("string").alias("_item"),
                         words(F.col("text")).alias("_words")).where(F.size("_words") > 0)
    length = F.least(F.size("_words"), F.lit(window))
    # at most `window` values
    lengths = sorted(r[0] for r in bench.select(length.alias("n")).distinct().collect())
    bench = bench.withColumn("_own", length)
    prints = (_windows(bench, ["_own"], lengths, gram, True).where("_len = _own")
              .select(F.col("_len").alias("_blen"), F.col("_print").alias("_bprint")).distinct())
    texts = (_windows(bench, ["_item", "_own"], lengths, gram, False, True).where("_len = _own")
             .groupBy(F.col("_len").alias("_tlen"), F.col("_text").alias("_ttext"))
             .agg(F.array_sort(F.collect_set("_item")).alias("_items")))
    prints, texts = small(prints, BROADCAST_ROWS), small(texts, BROADCAST_ROWS)
    same = (F.col("_print") == F.col("_bprint")) & (F.col("_len") == F.col("_blen"))

    # First pass: fingerprints alone; one row per document remains.
    doc = docs.select(*key, words(F.col("text")).alias("_words"))
    first = (_windows(doc.withColumn("n_words", F.size("_words")), [*key, "n_words"], lengths, gram,
                      True).join(prints, same, "left"))
    first = (first.where(F.col("_at").isNull() | (F.col("_at") == 0) | F.col("_bprint").isNotNull())
             .groupBy(*key)
             .agg(F.count(F.when(F.col("_at").isNull() | (F.col("_at") == 0), 1)).alias("_rows"),
                  F.max("n_words").cast("long").alias("n_words"),
                  F.max(F.col("_bprint").isNotNull()).alias("_hit")))
    first = written(first.withColumn("copies", F.floor(
        F.col("_rows") / max(1, len(lengths))).cast("long")).drop("_rows"), "fingerprints")

    # Second pass, over documents with a hit: extend it to all windows that keep its hash.
    hit = small(first.where("_hit").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]),
                BROADCAST_ROWS)
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    again = docs.join(hit, on, "left_semi").dropDuplicates(key)
    again = again.select(*key, words(F.col("text")).alias("_words"))
    exact = (_windows(again, key, lengths, gram, False, True)
             .join(prints, same, "left_semi")
             .join(texts, (F.col("_text") == F.col("_ttext")) & (F.col("_len") == F.col("_tlen"))))
    exact = (exact.groupBy(*key)
             .agg(F.array_sort(F.collect_set(F.struct(
                 F.col("_at").alias("s"), (F.col("_at") + F.col("_len")).alias("e")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"))
             .select("spans", "items", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]))
    return (first.drop("_hit").join(exact, on, "left").drop(*[f"_k{i}" for i in range(len(key))])
            .withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
        F.greatest(a["end"], x["e"]).alias("end")), lambda a: a["n"])


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a window),
    n_items, items_sha256 (of the sorted, comma-joined ids; of the empty text for none),
    contaminated. Rows without text have no words; repeated rows are returned as often."""
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("_md5"), "text")
    found = find_hits(keyed, items, ["doc_id", "_md5"])
    return (found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.size("spans") > 0).alias("contaminated")))
