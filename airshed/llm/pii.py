"""Personal data by bootstrapped contextual extraction.

Regular expressions with checks find the seed entities (email, ip, card, phone). The words around
them make lexical patterns; patterns and the values that stand in them form a graph. Scores move
to and fro: a pattern is worth the mean score of its values, a value the score of its best confident
pattern. Confident patterns thus lead from seeds to identifiers of forms that no expression knows;
those are reported with the kind of the pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import small, written

KINDS = ("email", "ip", "card", "phone")
# The expressions of the contract, with possessive quantifiers and look-behinds that
# keep the matches and make each search linear in the length of the text.
_LOCAL = "[A-Za-z0-9._%+-]"
EXPRESSIONS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]++(?:[ -][0-9]++)*+",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: A text without a match of this has no valid match of the expression.
_HINTS = ("@", r"[0-9]\.[0-9]", r"[0-9](?:[ -]?[0-9]){13}", r"\+[0-9]")
_MARK, _JOIN = "\ue000", "\ue001"  # of seeds in a text

CONFIDENT = 0.75  # least score of a pattern that finds
SUPPORT = 3  # least number of distinct scored values in it
SEEDED = 1_000_000  # lists of keys, patterns and values up to this length are broadcast


def _found(text: Column, kind: int, expression: str, hint: Column) -> Column:
    """Matches in order: kind, i, gap (characters since the last match), match."""
    matches = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    pieces = F.split(text, expression, -1)
    zipped = F.arrays_zip(matches.alias("m"), pieces.alias("p"))
    spans = F.transform(F.slice(zipped, 1, F.size(pieces) - 1), lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(z["p"]).alias("gap"),
        z["m"].alias("match")))
    return F.when(hint, spans).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<kind:int,i:int,gap:int,match:string>>"


def _valid() -> Column:
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split("match", r"\."), lambda p: F.ltrim(p, F.lit("0")))
    octets = F.forall(parts, lambda p: (F.length(p) <= 3)
                      & (F.lpad(p, 3, "0") <= "255"))
    back = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    luhn = F.aggregate(
        F.transform(back, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9)
                    .otherwise(2 * d)), F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0
    return (F.when(F.col("kind") == 1, octets)
            .when(F.col("kind") == 2, n.between(14, 19) & F.when(n.between(14, 19), luhn)
                  .otherwise(False))
            .when(F.col("kind") == 3, n.between(10, 15)).otherwise(True))


def find_tokens(docs: DataFrame) -> DataFrame:
    """One row per (doc_id, key) and match of an expression, with start and end in code points and
    whether the match is valid, and one row of kind -1 with the number of rows of that key. ``key``
    is the md5 of the text; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", F.md5(text.cast("binary")).alias("key"), text.alias("text"))
    hints = [F.col("text").contains(_HINTS[0]), *[F.col("text").rlike(h) for h in _HINTS[1:]]]
    docs = docs.select("*", *[h.alias(f"_h{i}") for i, h in enumerate(hints)])
    docs = docs.select("doc_id", "key", *[
        _found(F.col("text"), i, e, F.col(f"_h{i}")).alias(f"_m{i}")
        for i, e in enumerate(EXPRESSIONS)])
    head = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"),
                            F.lit("").alias("match")))
    rows = (docs.select("doc_id", "key", F.explode_outer(F.concat(
        head, *[f"_m{i}" for i in range(len(KINDS))])).alias("m")).select("doc_id", "key", "m.*"))
    # Rows of equal key have equal matches: they are counted, then taken once.
    rows = (rows.groupBy("doc_id", "key", "kind", "i")
            .agg(F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ("gap", "match")]))
    before = (Window.partitionBy("doc_id", "key", "kind").orderBy("i")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = F.length("match")
    return (rows.withColumn("end", F.sum(F.col("gap") + size).over(before).cast("int"))
            .withColumn("start", F.col("end") - size)
            .withColumn("valid", (F.col("kind") >= 0) & _valid())
            .drop("i", "gap"))


def _marked(docs: DataFrame, base: DataFrame) -> DataFrame:
    """key and text of each row, where each seed (those that overlap as one) is a word or part of one:
    _MARK and its kind stand before it, and its spaces are _JOIN."""
    by_key = Window.partitionBy("key").orderBy("start", "kind", "end")
    before = F.max("end").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    seeds = (base.select("key", "kind", "start", "end").distinct()
             .withColumn("_new", (F.col("start") >= F.coalesce(before, F.lit(0))).cast("int"))
             .withColumn("_g", F.sum("_new").over(
                 by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .groupBy("key", "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                       F.min("kind").alias("kind"))
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind")))
                                 .alias("seeds")))
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.md5(text.cast("binary")).alias("key"),
                        F.translate(text, _MARK + _JOIN, "??").alias("text"))
    piece = lambda at, end: F.col("text").substr(at + F.lit(1), end - at)
    last = lambda i: F.when(i > 0, F.get("seeds", i - 1)["end"]).otherwise(0)
    marked = F.concat(F.array_join(F.transform("seeds", lambda x, i: F.concat(
        piece(last(i), x["start"]), F.lit(_MARK), x["kind"].cast("string"),
        F.translate(piece(x["start"], x["end"]), " ", _JOIN))), ""),
        piece(last(F.size("seeds")), F.length("text")))
    return texts.join(small(seeds, SEEDED), "key", "left").select(
        "key", F.when(F.col("seeds").isNull(), F.col("text")).otherwise(marked).alias("text"))


def _words(texts: DataFrame) -> DataFrame:
    """Each word of the marked texts: key, i, word, before (two words), after."""
    texts = texts.select("key", F.array_remove(F.split("text", r"\s+"), "").alias("w"))
    n = F.size("w")
    none = lambda k: F.array(*[F.lit("")] * k)
    first = lambda k: F.slice("w", 1, F.greatest(n - k, F.lit(0)))
    rows = texts.where(n > 0).select("key", F.posexplode(F.arrays_zip(
        F.col("w").alias("word"), F.slice(F.concat(none(1), first(1)), 1, n).alias("l1"),
        F.slice(F.concat(none(2), first(2)), 1, n).alias("l2"),
        F.concat(F.slice("w", 2, n), none(1)).alias("r1"))).alias("i", "z"))
    return rows.select("key", "i", "z.*")


def _slots(words: DataFrame) -> DataFrame:
    """key, i, word and patterns (the words before and after) of each word."""
    l1, l2, r1 = (F.lower(c) for c in ("l1", "l2", "r1"))
    pattern = lambda name, *c: F.when(
        F.least(*[F.length(x) for x in c], F.lit(9)) > 0, F.concat_ws(" ", F.lit(name), *c))
    return words.select("key", "i", "word", F.explode(F.array(
        pattern("1", l1), pattern("2", l2, l1), pattern("x", l1, F.lit("_"), r1)))
        .alias("pattern")).where("pattern is not null")


def _valued(words: DataFrame) -> DataFrame:
    """``words`` with value (bare of punctuation, in lower case) and kind (of the seed in it, or null)."""
    seed = F.col("word").contains(_MARK)
    value = F.when(seed, F.regexp_extract("word", rf"{_MARK}[0-9](.*?)[^\p{{L}}\p{{N}}]*$", 1)).otherwise(
        F.regexp_extract("word", r"^[^\p{L}\p{N}]*+(.*?)[^\p{L}\p{N}]*$", 1))
    kind = F.regexp_extract("word", f"{_MARK}([0-9])", 1)
    return (words.withColumn("value", F.lower(value))
            .withColumn("kind", F.when(seed, kind.cast("int"))).where("value <> ''"))


def _hopeful(slots: DataFrame, support: DataFrame) -> DataFrame:
    """The patterns of ``support`` that can be confident: those with at most sum / CONFIDENT values.

    Values set bits of a map, twice as many bits as the pattern may have values, in words of 64. No value
    sets two bits, so a map with more bits than that holds too many values, and its pattern is out. Maps
    are combined before the shuffle: common patterns such as "the _" cost a few words for each task, and
    not a row for each value. Patterns just above the bound stay; their values are counted later.
    """
    most = F.floor(F.max("sum") / CONFIDENT).cast("long")
    names = support.groupBy("pattern").agg(most.alias("most")).withColumn(
        "parts", F.ceil(F.col("most") * 2 / 64).cast("long"))
    values = _valued(slots.join(small(names, SEEDED), "pattern"))
    place = F.xxhash64("value")
    bit = F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")
    maps = (values.select("pattern", "most", place.alias("place"), F.pmod(F.xxhash64("value", F.lit(1)),
                                                                        "parts").alias("part"))
            .groupBy("pattern", "most", "part").agg(F.bit_or(bit).alias("bits")))
    return (maps.groupBy("pattern", "most").agg(F.sum(F.bit_count("bits").cast("long")).alias("least"))
            .where(F.col("least") <= F.col("most")).select("pattern"))


def _discover(words: DataFrame) -> DataFrame:
    """key, i, kind and score of the words that are unseen identifiers: values with digits wherever they
    stand, others, which only emails can be, in the slots of confident patterns. A pattern counts all
    values in its slot; only those with SUPPORT, which alone can be confident, are looked up. Rounds go on
    until they find no value that was not found before; scores only rise, so they come to an end."""
    slots = _slots(words)
    known = written(_valued(slots.where(F.col("word").contains(_MARK)))
                    .select("pattern", "value", "kind").distinct()
                    .withColumn("score", F.lit(1.0)), "seeds")
    seeds = known.select("value").distinct()
    has_digit = F.col("value").rlike("[0-9]")
    none = words.select("key", "i", F.lit(0).alias("kind"), F.lit(0.0).alias("score")).limit(0)
    scored, found = known, None
    while True:
        support = written(scored.groupBy("pattern", "kind")
                          .agg(F.sum("score").alias("sum"), F.count("*").alias("support"))
                          .where(F.col("support") >= SUPPORT), "support")
        hopeful = written(_hopeful(slots, support), "hopeful")
        if not hopeful.head(1):
            return none
        edges = written(_valued(slots.join(small(hopeful, SEEDED), "pattern")).select("pattern", "value")
                        .distinct(), "edges")
        sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
        confident = written(support.join(sizes, "pattern").select(
            "pattern", "kind", (F.col("sum") / F.col("n")).alias("score"))
            .where(F.col("score") >= CONFIDENT), "confident")
        new = written(edges.join(confident, "pattern").where((F.col("kind") == 0) | has_digit)
                      .groupBy("value", "kind").agg(F.max("score").alias("score"))
                      .join(seeds, "value", "left_anti"), "round")
        if not new.head(1):
            return none
        if found is not None and not new.join(found, ["value", "kind"], "left_anti").head(1):
            break
        found = new
        values = small(new.withColumnRenamed("kind", "_kind"), SEEDED)
        more = (_valued(slots).where("kind is null").drop("kind").join(values, "value")
                .select("pattern", "value", F.col("_kind").alias("kind"), "score").distinct())
        scored = written(known.unionByName(more), "scored")
    anywhere = (_valued(words).where("kind is null").drop("kind")
                .join(small(new.where(has_digit), SEEDED), "value"))
    there = (_valued(slots).where("kind is null").drop("kind").where(~has_digit)
             .join(small(confident.where("kind = 0"), SEEDED), "pattern")
             .join(seeds, "value", "left_anti"))
    return anywhere.select("key", "i", "kind", "score").unionByName(
        there.select("key", "i", "kind", "score"))


def _places(texts: DataFrame, new: DataFrame) -> DataFrame:
    """key, kind, start and end of the words in ``new`` (key, i, kind), in code points of the text."""
    texts = texts.join(small(new.select("key").distinct(), SEEDED), "key", "left_semi")
    words = F.array_remove(F.split("text", r"\s+"), "")
    # white space before the word; the first piece is that before the first word
    gaps = F.split("text", r"\S+", -1)
    rows = (texts.dropDuplicates(["key"]).select("key", F.posexplode(F.arrays_zip(
        words.alias("word"), F.slice(gaps, 1, F.size(words)).alias("gap"))).alias("i", "z"))
        .select("key", "i", "z.*"))
    before = (Window.partitionBy("key").orderBy("i")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = lambda c: F.length(F.regexp_replace(c, f"{_MARK}[0-9]", ""))
    rows = rows.withColumn("end", F.sum(F.length("gap") + size("word")).over(before).cast("int"))
    lead = F.length(F.regexp_extract("word", r"^[^\p{L}\p{N}]*+", 0))
    tail = F.length(F.regexp_extract("word", r"[^\p{L}\p{N}]*$", 0))
    return rows.join(new, ["key", "i"]).select(
        "key", "kind", (F.col("end") - F.length("word") + lead).alias("start"),
        (F.col("end") - tail).alias("end"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (valid matches), base_sha256 (of
    kind:start:end of these, by start, then kind, comma-joined), spans (these and the discovered
    ones). Null and empty texts have none; repeated rows are returned as often."""
    found = written(find_tokens(docs), "tokens")
    base = found.where("valid").select("doc_id", "key", "kind", "start", "end")
    texts = written(_marked(docs, base), "texts")
    new = written(_discover(_words(texts)).groupBy("key", "i").agg(F.min_by("kind", F.struct(
        -F.col("score"), "kind")).alias("kind")), "new")
    heads = found.where("kind = -1").select("doc_id", "key")
    new = (heads.join(_places(texts, new), "key")
           .select("doc_id", "key", "kind", "start", "end", F.lit(False).alias("base")))
    spans = base.withColumn("base", F.lit(True)).unionByName(new)
    names = F.array(*map(F.lit, KINDS))
    by_doc = spans.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("all"))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base_of = F.filter("all", lambda s: s["base"])
    count = lambda i: F.size(F.filter("all", lambda s: s["base"] & (
        s["kind"] == i))).cast("long")
    out = (found.where("kind = -1").select("doc_id", "key", "rows")
           .join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
           .withColumn("all", F.coalesce("all", F.array().cast(
               "array<struct<start:int,kind:int,end:int,base:boolean>>")))
           .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))))
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      F.sha2(text(base_of).cast("binary"), 256).alias("base_sha256"),
                      text(F.col("all")).alias("spans"))
