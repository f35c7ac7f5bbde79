"""SpotSigs document fingerprints with DataFrame functions only.

A spot is a common word (anchor); its signature is the anchor and the first
content words that follow it, up to the next anchor; a run of content words
without an anchor is broken after every few words, and each part starts a chain
of its own.  A text's fingerprint is
its set of hashed signatures, written as sorted hexadecimal numbers, so two
fingerprints can be compared by themselves.  ``edited_fingerprints`` gives plain
likenesses, unpruned.  ``near_sets`` matches all documents: sets are partitioned
by length, since at a likeness of ``least`` or more only sets of the same or the
neighbouring partition can meet, and the ratio of lengths bounds the Jaccard
likeness before any signature is compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Common words of English, French, German and Spanish that anchor signatures.
ANCHORS = (
    "the of and to in a is that it for on was be with as this by at are an from "
    "le la les de des et un une du en au que qui est pour dans sur par pas "
    "der die das und den von zu mit sich auf ein eine im ist nicht dem für "
    "el los las y no por con del para se"
).split()
CHAIN = 2
#: Words of a run after which a chain starts without an anchor.
RUN = 5
#: Texts of at most so many words have each word as a further signature.
SHORT = 16
LEAST = 0.8
#: A signature of more sets than this is matched in several parts.
HOT = 1000


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN, anchors: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``: the sorted distinct signatures (int) of column ``text``.

    Words are lower-cased runs of letters and digits; the words before the
    first anchor are a run too.  A text without words, null as the empty text,
    has the hash of the text; one whose words give no chain (anchors only) has
    each word.  So the set is never empty.
    """
    words = "|".join(sorted(set(anchors or ANCHORS)))
    norm, segs, sigs = f"__{out}_norm", f"__{out}_segs", f"__{out}_sigs"
    df = df.withColumn(norm, F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" ")))
    marked = F.regexp_replace(F.col(norm), f" (?:{words})(?= )", "\n$0")
    marked = F.regexp_replace(marked, f"((?: [^ \n]+){{{RUN}}})(?= [^ \n])", "$1\n")
    df = df.withColumn(segs, F.split(marked, "\n"))
    found = F.filter(F.transform(F.col(segs), lambda s: F.trim(F.substring_index(F.ltrim(s), " ", chain + 1))), lambda s: F.instr(s, " ") > 0)
    df = df.withColumn(sigs, found).withColumn(segs, F.split(F.trim(F.substring_index(F.col(norm), " ", SHORT + 2)), " "))
    chosen = (
        F.when(F.trim(F.col(norm)) == "", F.array(F.coalesce(F.col(text), F.lit(""))))
        .when(F.trim(F.substring_index(F.col(norm), " ", SHORT + 2)) == F.trim(F.col(norm)), F.concat(F.col(sigs), F.col(segs)))
        .when(F.size(sigs) == 0, F.split(F.trim(F.col(norm)), " "))
        .otherwise(F.col(sigs))
    )
    df = df.withColumn(sigs, chosen)
    return df.withColumn(out, F.array_sort(F.array_distinct(F.transform(F.col(sigs), lambda s: F.hash(s))))).drop(norm, segs, sigs)


def as_text(signatures: Column) -> Column:
    """The set as text: eight hexadecimal digits for each signature."""
    return F.lower(F.concat_ws("", F.transform(signatures, lambda x: F.lpad(F.hex(F.pmod(x.cast("long"), F.lit(1 << 32))), 8, "0"))))


def length_partition(signatures: Column, least: float = LEAST) -> Column:
    """Number of the set's length partition; likeness of ``least`` is possible within one step only."""
    return F.floor(F.log(F.size(signatures).cast("double")) / F.lit(-math.log(least))).cast("int")


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 where the lengths already bound it below ``least``, 1 of two empty sets."""
    bound = F.least(F.size(a), F.size(b)) / F.nullif(F.greatest(F.size(a), F.size(b)), F.lit(0))
    both = F.size(F.array_intersect(a, b))
    return F.when(a.isNull() | b.isNull() | (bound < least), F.lit(0.0)).otherwise(F.coalesce(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(1.0)))


def with_next(docs: DataFrame, buckets: int) -> tuple[DataFrame, object]:
    """``docs`` dealt to ranges of ``doc_id``, each range with the row that follows it.

    Returns the rows (``range``, ``ghost``: 1 for a copy of the next range's
    first row, 2 for the very first row behind the last) and the window in which
    ``lead`` is the next document.  Only ``buckets`` bounds reach the driver.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("__key", key)
    shares = [i / buckets for i in range(1, buckets)]
    got = keyed.agg(F.min("__key").alias("low"), F.percentile_approx("__key", shares, 100 * buckets).alias("at")).first()
    bounds = sorted(set(got["at"] or []) - {got["low"]})
    last = len(bounds)
    at = F.lit(0)
    if bounds:
        at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("__key")))
    keyed = keyed.withColumn("__range", at)
    own = F.struct(F.col("__range").alias("range"), F.lit(0).alias("ghost"))
    before = F.when(F.col("__key").isin(bounds), F.struct((F.col("__range") - 1).alias("range"), F.lit(1).alias("ghost")))
    round_ = F.when(F.col("__key") == F.lit(got["low"]), F.struct(F.lit(last).alias("range"), F.lit(2).alias("ghost")))
    dealt = keyed.withColumn("__to", F.explode(F.array_compact(F.array(own, before, round_)))).drop("__range").select("*", "__to.range", "__to.ghost").drop("__to")
    dealt = dealt.withColumn("__behind", F.col("ghost") == 2).withColumn("__tie", F.xxhash64("text"))
    return dealt, Window.partitionBy("range").orderBy("__behind", "__key", "ghost", "__tie")


def edited_fingerprints(docs: DataFrame, buckets: int | None = None, chain: int = CHAIN, least: float = 0.0) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likenesses.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document by ascending id; the first
    follows the last.  A null id comes before all others; rows with one id
    follow each other by a hash of their text.  Null texts count as empty.  No
    rows give no rows; other columns than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    buckets = buckets or min(2000, max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt, order = with_next(rows, buckets)
    half = F.floor(F.char_length("text") / 2).cast("int")
    dealt = dealt.withColumn("next_text", F.lead("text").over(order))
    dealt = with_signatures(dealt, "text", "signatures", chain)
    dealt = dealt.withColumn("next_signatures", F.lead("signatures").over(order)).where("ghost = 0")
    edited = dealt.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half)))
    edited = edited.select("doc_id", "n_chars", "edited", "signatures", "next_signatures")
    edited = with_signatures(edited, "edited", "edited_signatures", chain)
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("signatures")).alias("fingerprint"),
        as_text(F.col("edited_signatures")).alias("edited_fingerprint"),
        pruned_jaccard(F.col("signatures"), F.col("edited_signatures"), least).alias("near_edited"),
        pruned_jaccard(F.col("signatures"), F.col("next_signatures"), least).alias("near_next"),
        F.size("signatures").cast("long").alias("n_signatures"),
        length_partition(F.col("signatures")).alias("length_partition"),
    )


def near_sets(docs: DataFrame, least: float = LEAST, chain: int = CHAIN, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, set_id) and pairs (a, b, likeness): all pairs of distinct fingerprints from ``least`` on.

    Documents of one fingerprint are one set.  Two such sets share one of the
    rarest n - ceil(least n) + 1 signatures of each; those meet by signature and
    length partition, within the bound of lengths, before likenesses are
    computed.  ``a`` is the smaller set (or the first by id).
    """
    own = with_signatures(docs.select("doc_id", "text"), "text", "signatures", chain).select("doc_id", F.md5(as_text(F.col("signatures"))).alias("set_id"), "signatures")
    own = materialize(own, "spotsigs")
    sets = materialize(own.dropDuplicates(["set_id"]).select("set_id", "signatures"), "spotsets")
    each = sets.select("set_id", F.explode("signatures").alias("sig"))
    ranked = each.join(each.groupBy("sig").agg(F.count("*").alias("n_sets")), "sig").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("n_sets", "sig"))).alias("by_rarity"))
    size = F.size("by_rarity")
    prefix = (size - F.ceil(F.lit(least) * size - 1e-9) + 1).cast("int")
    ranked = ranked.select("set_id", size.alias("n"), length_partition(F.col("by_rarity"), least).alias("part"), F.explode(F.slice("by_rarity", F.lit(1), prefix)).alias("s"))
    split = F.ceil(F.col("s.n_sets") / F.lit(hot)).cast("int")
    keyed = materialize(ranked.where("s.n_sets > 1").select("set_id", "n", "part", F.col("s.sig").alias("sig"), split.alias("split")), "spotprefixes")
    small = keyed.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), "part", "sig", F.pmod(F.xxhash64("set_id"), F.col("split")).cast("int").alias("salt"))
    large = keyed.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "sig", "split")
    large = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("split") - 1))).drop("split")
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    met = small.join(large, ["sig", "part", "salt"]).where(ordered & (F.col("n_a") >= F.lit(least) * F.col("n_b") - 1e-9)).select("a", "b").distinct()
    with_a = met.join(sets.select(F.col("set_id").alias("a"), F.col("signatures").alias("sigs_a")), "a")
    with_b = with_a.join(sets.select(F.col("set_id").alias("b"), F.col("signatures").alias("sigs_b")), "b")
    pairs = with_b.select("a", "b", pruned_jaccard(F.col("sigs_a"), F.col("sigs_b"), least - 1e-9).alias("likeness")).where(F.col("likeness") >= F.lit(least - 1e-12))
    return own.select("doc_id", "set_id"), pairs
