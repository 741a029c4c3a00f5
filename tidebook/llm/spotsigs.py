"""Document fingerprints by SpotSigs, in DataFrame functions.

A signature starts at an anchor, a common function word, and chains the next CHAIN content words; words
in between that are themselves anchors are stepped over. Where CHAIN + 2 content words follow each other
with no anchor between, the first of them serves as an anchor, so that texts without function words are
covered by the same local rule. A fingerprint is the sorted set of its signatures' hashes, eight hex
digits each. Two fingerprints are compared by the Jaccard likeness of
their sets; sets are partitioned by length, since sets whose lengths differ by more than the threshold
allows need no comparison, and within a length range only the rarest signatures of a set are looked up.

Defined results: a null text counts as empty and has an empty fingerprint; two empty fingerprints have
likeness 1, an empty and another one 0; a text without any complete chain has its whole word sequence,
or its characters if it has no words, as its one signature; equal texts have equal fingerprints; the neighbour order is by id descending, null ids last, then
by text, so repeated rows follow each other; a table of one row is its own neighbour; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import components, materialize

CHAIN = 2
# Function words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he in is it of on or she that the they this to was we were with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur ne pas pour qui que sur un une "
    "als auf aus das dem den der des die ein eine einer er für ich im in ist mit nicht sich sie und von zu "
    "al como con del el es esta la las lo los más no para por que se su un una y"
)
_MARK = "\x01"
ZONES = 6  # id ranges for each shuffle partition


def _anchor_pattern() -> str:
    """The anchors as one pattern, grouped by first letter so that most words fail at once."""
    by: dict[str, list[str]] = {}
    for word in sorted(set(ANCHORS.split())):
        by.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{c}(?:{'|'.join(rest)}) " for c, rest in by.items())


def with_signatures(df: DataFrame, text_col: str, out: str, chain: int = CHAIN) -> DataFrame:
    """df with out: the signatures of text_col as a sorted array of distinct 32-bit hashes.

    Each step is a column of its own, so that none is evaluated twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]+", " "), F.lit(" "))
    df = df.withColumn("_plain", plain)
    df = df.withColumn("_marked", F.regexp_replace("_plain", f"(?<= )(?={_anchor_pattern()})", _MARK))
    word = f"[^ {_MARK}][^ ]*+"
    links = f" (?:{_MARK}[^ ]++ )*+{word}" * chain
    spots = F.regexp_extract_all("_marked", F.lit(f"{_MARK}(?=([^ ]++{links}) )"), F.lit(1))
    runs = F.regexp_extract_all("_marked", F.lit(f"(?<= )(?=({word}{(' ' + word) * chain}) {word} )"), F.lit(1))
    df = df.withColumn("_spots", spots).withColumn("_runs", runs)
    clean = F.transform("_spots", lambda s: F.when(F.instr(s, " " + _MARK) > 0, F.regexp_replace(s, f" {_MARK}[^ ]+", "")).otherwise(s))
    df = df.withColumn("_found", F.concat(clean, "_runs"))
    whole = F.array(F.when(F.trim("_plain") != "", F.trim("_plain")).otherwise(text))
    chosen = F.when(F.size("_found") > 0, F.col("_found")).when(text == "", F.expr("cast(array() as array<string>)")).otherwise(whole)
    hashed = F.array_sort(F.array_distinct(F.transform(chosen, lambda s: F.xxhash64(s).bitwiseAND(F.lit(0xFFFFFFFF)))))
    return df.withColumn(out, hashed).drop("_plain", "_marked", "_spots", "_runs", "_found")


def fingerprint(sigs: Column) -> Column:
    """A signature set as a string of eight hex digits for each."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 without comparing them if their lengths rule out least."""
    both = F.size(F.array_intersect(a, b))
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    value = F.when(long == 0, F.lit(1.0)).when(short == 0, F.lit(0.0)).otherwise(both / (short + long - both))
    return F.when(short < F.lit(least) * long, F.lit(0.0)).otherwise(value) if least else value


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each row and the one that follows it by descending id, cyclically.

    Rows are dealt into id ranges by approximate quantiles and paired inside their range; the last row of
    a range takes the first of the next one from a table of one row a range.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = ZONES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = src.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    # Range 0 holds the largest ids; a null id is in the last one.
    bounds = sorted({int(c) for c in cuts or []})
    zone = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(len(bounds) - _below(bounds, F.col("doc_id"))).cast("int")
    dealt = src.withColumn("zone", zone)
    top = dealt.groupBy("zone").agg(F.max("doc_id").alias("top"))
    top = materialize(top, "spot-ranges")
    heads = dealt.join(F.broadcast(top.withColumnRenamed("zone", "z")), (F.col("zone") == F.col("z")) & F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("zone").agg(F.min("text").alias("head"))
    heads = materialize(with_signatures(heads, "head", "head_sigs"), "spot-heads")
    zones = [r["zone"] for r in heads.select("zone").orderBy("zone").collect()]
    follow = {z: zones[(i + 1) % len(zones)] for i, z in enumerate(zones)}
    pairs = spark.createDataFrame(list(follow.items()) or [(-1, -1)], "zone int, follows int")
    heads = F.broadcast(heads.withColumnRenamed("zone", "follows").join(F.broadcast(pairs), "follows").select("zone", "head", "head_sigs"))
    w = Window.partitionBy("zone").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    own = with_signatures(dealt, "text", "sigs")
    paired = own.withColumns({"after": F.lead("text").over(w), "after_sigs": F.lead("sigs").over(w)})
    return paired.join(heads, "zone").select("doc_id", "text", "sigs", F.coalesce("after", "head").alias("next_text"), F.coalesce("after_sigs", "head_sigs").alias("next_sigs"))


def _below(bounds: list[int], x: Column) -> Column:
    """How many of the sorted bounds are less than x, by bisection."""
    if not bounds:
        return F.lit(0)
    table = F.expr(f"array({','.join(f'{b}L' for b in bounds)})")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) < x, at + step).otherwise(at))


def edited(text: Column, other: Column) -> Column:
    """text with its last half of code points replaced by as many, or all, from the start of other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (F.length(text) - half).cast("int")), F.substring(other, F.lit(1), half))


def near_duplicates(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked by a likeness of least or more."""
    rows = with_signatures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text", "sigs").drop("text")
    rows = materialize(rows.withColumn("key", F.xxhash64("sigs")), "spot-sets")
    return rows.join(linked(rows, least), "key").select("doc_id", fingerprint(F.col("sigs")).alias("fingerprint"), "component_id")


def linked(rows: DataFrame, least: float) -> DataFrame:
    """(key, root, component_id) for every set of the written rows (doc_id, sigs, key), linked by a likeness of least.

    Equal fingerprints collapse to one set. Sets are indexed by their rarest signatures only: two sets of
    the likeness share one of the first n - ceil(least * n) + 1 in the order of rarity. Set lengths fall
    into zones whose bounds grow by 1/least, so only the own and the next zone are compared. Within one
    (signature, zone) each set is first compared with the first set there and with the one before it, in
    rounds that merge what is linked until a round links nothing; then all pairs of sets that are still
    in different classes are compared, which makes the result exact without listing the pairs of a class.
    """
    sets = materialize(rows.groupBy("key").agg(F.min("doc_id").alias("low"), F.any_value("sigs").alias("sigs")), "spot-distinct")
    freq = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("n"))
    told = sets.select("key", F.size("sigs").alias("size"), F.explode("sigs").alias("sig")).join(freq, "sig")
    order = F.array_sort(F.collect_list(F.struct("n", "sig")))
    lead = F.expr(f"slice(o, 1, cast(size - ceil({least!r}D * size) + 1 as int))")
    heads = told.groupBy("key", "size").agg(order.alias("o")).select("key", "size", F.explode(lead).alias("h")).filter("h.n > 1")
    zone = F.floor(F.log(F.col("size").cast("double")) / F.lit(math.log(1.0 / least)))
    index = heads.select("key", "size", F.col("h.sig").alias("sig"), F.explode(F.array(zone, zone + 1)).alias("zone"), zone.alias("own"))
    index = materialize(index, "spot-index")
    x = sets.select(F.col("key").alias("a"), F.col("sigs").alias("sa"))
    y = sets.select(F.col("key").alias("b"), F.col("sigs").alias("sb"))
    links = None
    root = sets.select("key", F.col("key").alias("root"))
    last = False
    while True:
        here = index.join(root, "key").select("sig", "zone", "key", "root", "size")
        if last:
            there = here.select("sig", "zone", F.col("key").alias("other"), F.col("root").alias("other_root"))
            pairs = here.join(there, ["sig", "zone"]).filter("root <> other_root").select("key", "other")
        else:
            w = Window.partitionBy("sig", "zone").orderBy("root", "size", "key")
            beside = {f"{name}_{c}": f(c).over(w) for name, f in (("before", F.lag), ("first", F.first)) for c in ("key", "root")}
            both = F.array(*[F.struct(F.col(f"{name}_key").alias("other"), F.col(f"{name}_root").alias("root")) for name in ("before", "first")])
            near = here.withColumns(beside).select("key", "root", F.explode(both).alias("o"))
            pairs = near.filter("o.other IS NOT NULL AND o.root <> root").select("key", "o.other")
        pairs = pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
        good = materialize(pairs.join(x, "a").join(y, "b").filter(likeness(F.col("sa"), F.col("sb"), least) >= least).select("a", "b"), "spot-links")
        if not good.isEmpty():
            links = good if links is None else links.union(good)
            found = components(links, "spot-classes")
            root = materialize(sets.select("key").join(found, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("root")), "spot-roots")
        elif not last:
            last = True
            continue
        if last:
            break
    named = root.join(sets, "key").groupBy("root").agg(F.min("low").alias("component_id"))
    return materialize(root.join(named, "root").select("key", "root", "component_id"), "spot-known")
