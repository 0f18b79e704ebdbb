"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text's terms are its words, weighted by how often they occur.  Each of a term's first ``levels`` unit
levels has, in each of ``samples`` draws, a rank that is a hash of the term and the level: uniform, so no
logarithm is taken.  What a weight has above them is sampled as one, however much it is: gamma and uniform
variates that depend on the term alone give it a level not above that weight and an exponential variate of
that rate, which goes back to the same uniform scale.  The level of least rank is the sample.  The odds that
two texts' samples are equal are their generalised Jaccard similarity: the sum of the lesser weights over the
sum of the greater.

A text is sampled where it is read from, term by term, and only least ranks are kept.  For edits that
need the next document, rows are dealt by ranges of doc_id, as many as tasks; each range also gets the
row that follows its last one, so texts move once and no window spans all rows.

Edge cases: a null or empty text has an empty fingerprint, which is alike (1.0) only to another empty
one; texts of any length are read whole, as one row's terms; equal texts have equal fingerprints; a null
doc_id comes first, also as what follows the last one; rows that share a doc_id are ordered by text, and
which of them comes first makes no difference where the texts are equal; a lone document is its own next; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daystack.llm.common import texts

#: Draws: a likeness of s has a standard error of sqrt(s * (1 - s) / SAMPLES), 0.054 at 0.75 and 0.0625 at 0.5.
SAMPLES = 64
#: A term's weight up to here is sampled by unit levels, and what it has above by gamma variates.
LEVELS = 4
#: Ranges of doc_id for each partition of a shuffle.
RANGES = 4

_LOW = 0xFFFFFFFF


def _uniform(bits: Column, low: int, width: int) -> Column:
    """A number between 0 and 1, neither included, of ``width`` bits of a hash from bit ``low`` on."""
    part = F.shiftrightunsigned(bits, low) if low else bits
    part = part if low + width == 64 else part.bitwiseAND(F.lit((1 << width) - 1))
    return (part + F.lit(0.5)) * F.lit(2.0**-width)


def _above(term: Column, log_weight: Column, draw: int) -> Column:
    """The sample of the weight that a term has above its unit levels: rank (31 bits), then term and level as 32 bits.

    Two hashes of the term hold all its variates; a sample's name is made of both and the level.
    """
    x, y = (F.xxhash64(term, F.lit(2 * draw + k)) for k in range(2))
    r = -F.log(_uniform(x, 43, 21) * _uniform(x, 22, 21))  # gamma of shape 2
    log_c = F.log(-F.log(_uniform(y, 32, 32) * _uniform(y, 0, 32)))
    beta = _uniform(x, 0, 22)
    level = F.floor(log_weight / r + beta)
    log_a = log_c - r * (level - beta + F.lit(1.0))  # of an exponential variate whose rate is the weight
    rank = F.least(F.lit((1 << 31) - 1), (-F.expm1(-F.exp(log_a)) * F.lit(2.0**31)).cast("long"))
    name = x.bitwiseXOR(y).bitwiseAND(F.lit(_LOW)) + level
    return F.shiftleft(rank, 32).bitwiseOR(name.bitwiseAND(F.lit(_LOW)))


def _sample(term: Column, log_above: Column, draw: int) -> Column:
    """Rank of a unit level (its hash as it is), or of what lies above them: the least of all terms' is the sample."""
    unit = F.shiftrightunsigned(F.xxhash64(term, F.lit(draw)), 1)
    return F.when(log_above.isNull(), unit).otherwise(_above(term, log_above, draw))


def weighted_terms(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``: an array of (hash, count) of the text's words, none for null."""
    s, at = f"_{out}_sorted", f"_{out}_at"
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    rows = rows.withColumn(s, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))))
    # where each run of equal hashes begins, and one past the last
    begins = F.filter(F.sequence(F.lit(0), F.size(s)), lambda i: (i == 0) | (i == F.size(s)) | (F.get(s, i) != F.get(s, i - 1)))
    rows = rows.withColumn(at, F.when(F.size(s) > 0, begins).otherwise(F.array(F.lit(0))))
    runs = F.transform(F.slice(at, 1, F.size(at) - 1), lambda i, k: F.struct(F.get(s, i).alias("term"), (F.get(at, k + 1) - i).alias("n")))
    return rows.withColumn(out, runs).drop(s, at)


def fingerprints(rows: DataFrame, key: list[str], terms: str, samples: int, levels: int = LEVELS) -> DataFrame:
    """For each ``key`` its samples (array<long>, empty without terms); rows of a key must be together already."""
    each = rows.select(*key, F.explode_outer(terms).alias("_t")).select(*key, F.col("_t.term").alias("_term"), F.col("_t.n").alias("_n"))
    each = each.select(*key, "_term", "_n", F.explode_outer(F.sequence(F.lit(1), F.least("_n", F.lit(levels + 1)))).alias("_level"))
    above = F.when(F.col("_level") > levels, F.log((F.col("_n") - levels).cast("double")))
    each = each.select(*key, F.when(F.col("_term").isNotNull(), F.xxhash64("_term", "_level")).alias("_term"), above.alias("_w"))
    least = each.groupBy(*key).agg(F.count("_term").alias("_n"), *[F.min(_sample(F.col("_term"), F.col("_w"), k)).alias(f"_s{k}") for k in range(samples)])
    found = F.array(*[F.col(f"_s{k}").bitwiseAND(F.lit(_LOW)) for k in range(samples)])
    return least.select(*key, F.when(F.col("_n") == 0, F.array().cast("array<long>")).otherwise(found).alias("print"))


def likeness(a: str, b: str) -> Column:
    """Share of equal samples; two empty fingerprints are alike."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(equal / most)


def as_text(a: str) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _numbers(values: list[int]) -> Column:
    """An array of longs, written as one string: the planner gets a single value however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bucket_of(doc_id: str, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are not above ``doc_id``, by bisection; 0 for null."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    table = _numbers(bounds)
    return F.aggregate(_numbers(steps).cast("array<int>"), F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= F.col(doc_id), at + step).otherwise(at))


def ranged(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text, bucket, guard: rows by ranges of doc_id in order, each range with a copy (guard) of what follows it.

    Bounds of ranges are quantiles of doc_id, so that ranges are even however ids lie; the driver and
    the broadcast table get one row for each range.
    """
    rows = texts(docs)
    quantiles = [k / ranges for k in range(1, ranges)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", quantiles, max(10_000, 2 * ranges))).first()[0] if ranges > 1 else []
    rows = rows.withColumn("bucket", bucket_of("doc_id", sorted(set(found or []))))
    order = Window.orderBy("bucket")
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("_first"))  # a null id is the least
    last = F.max("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select(F.col("_first.doc_id").alias("_first"), F.coalesce(F.lag("bucket").over(order), last).alias("_before"))
    both = rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("_first")), "left")
    one = lambda b, g: F.struct(F.col(b).alias("bucket"), F.lit(g).alias("guard"))
    places = F.when(F.col("_before").isNull(), F.array(one("bucket", False))).otherwise(F.array(one("bucket", False), one("_before", True)))
    return both.select("doc_id", "text", F.explode(places).alias("_p")).select("doc_id", "text", "_p.bucket", "_p.guard")


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES, ranges: int | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ranges = ranges or RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy("bucket").orderBy("guard", "doc_id", "text")
    rows = ranged(docs, ranges).select("*", F.row_number().over(w).alias("row"), F.lead("text").over(w).alias("_next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.when(~F.col("guard"), F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.coalesce("_next", F.lit("")), F.lit(1), half)))
    rows = rows.select("bucket", "row", "guard", "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = weighted_terms(weighted_terms(rows, "text", "own"), "edited", "other")
    info = ["bucket", "row", "guard", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    two = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("own").alias("terms")), F.struct(F.lit(1).alias("which"), F.col("other").alias("terms"))))
    rows = rows.select(*info, two.alias("_x")).select(*info, "_x.which", "_x.terms")
    prints = fingerprints(rows, [*info, "which"], "terms", samples, levels)
    pair = prints.groupBy(*info).agg(F.max(F.when(F.col("which") == 0, F.col("print"))).alias("own"), F.max(F.when(F.col("which") == 1, F.col("print"))).alias("other"))
    pair = pair.withColumn("next", F.lead("own").over(Window.partitionBy("bucket").orderBy("row"))).where("not guard")
    return pair.select("doc_id", "n_chars", "edited_sha256", as_text("own").alias("fingerprint"), as_text("other").alias("edited_fingerprint"), likeness("own", "other").alias("near_edited"), likeness("own", "next").alias("near_next"))
