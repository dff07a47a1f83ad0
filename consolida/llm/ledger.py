"""Quality rules as a bitmask ledger.

DataFrame functions only.  ``ledger`` evaluates every rule once and stores one
failure bit per rule beside the measurements.  A policy is a versioned mask of
rules; applying one, or comparing several, is bit arithmetic on the ledger, and
``ablation`` counts in one bitwise aggregation what each rule rejects, alone
and with others.

Null and empty texts have no words and fail the length rule; a null doc_id is
carried along; repeated rows are separate documents; an empty table gives an
empty ledger (and an ablation of zeros).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

#: (name, failure over the ledger's measurements).  The position is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "100 * n_symbols > 15 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
    ("capitals", "n_upper > 50 and 100 * n_upper > 50 * word_chars"),
    ("equal_neighbours", "100 * n_same_next > 20 * n_words"),
    ("no_letters", "100 * n_letters < 50 * word_chars"),
)
#: Versioned policies: the rules each of them applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(name for name, _ in RULES),
}


def mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(r) for r in POLICIES[policy])


def measured(docs: DataFrame, *others: str) -> DataFrame:
    """All measurements of every row, from one look at its text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*others, text.alias("_t"))
    rows = rows.withColumn("_w", F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    rows = rows.withColumn("_bare", F.translate("_t", BLANKS, "")).withColumn("_l", lines)
    # Windows sorted with their places: one that equals a neighbour is repeated, and its words count up to the next repeated one's start.
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    places = F.when(F.col("_n") >= WINDOW, F.sequence(F.lit(1), F.col("_n") - (WINDOW - 1))).otherwise(F.expr("cast(array() as array<int>)"))
    rows = rows.withColumn("_g", F.transform(places, lambda i: F.xxhash64(*(F.get("_h", i + (k - 1)) for k in range(WINDOW)))))
    rows = rows.withColumn("_some", F.size("_g") > F.size(F.array_distinct("_g")))
    pairs = F.when(F.col("_some"), F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    rows = rows.withColumn("_s", pairs)
    same = lambda j: F.get("_s", j)["g"]
    kept = F.filter(
        F.transform("_s", lambda s, j: F.when((s["g"] == same(j + 1)) | ((j > 0) & (s["g"] == same(F.greatest(j - 1, F.lit(0))))), s["i"])),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("_p", F.when(F.col("_some"), F.sort_array(kept)))
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1), p + WINDOW) - p)), F.lit(0), lambda a, v: a + v
    )
    following = F.transform("_h", lambda h, i: (h == F.get("_h", i + 1)).cast("int"))
    return rows.select(
        *others,
        F.col("_n").cast("long").alias("n_words"),
        F.char_length("_bare").cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.char_length(F.regexp_replace("_bare", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.char_length(F.regexp_replace("_bare", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.aggregate(following, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))).cast("long").alias("n_same_next"),
    )


def ledger(docs: DataFrame, *others: str) -> DataFrame:
    """Measurements and the failure bits of all rules."""
    bits = sum((F.when(F.expr(failure), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, failure) in enumerate(RULES)), F.lit(0))
    return measured(docs, *others).withColumn("bits", bits.cast("long"))


def passes(policy: str, bits: str = "bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Of each rule of a policy: documents it fails, and documents only it fails (what dropping it would keep)."""
    names = [name for name, _ in RULES]
    under = F.col("bits").bitwiseAND(F.lit(mask(policy)))
    sums = [f(1 << names.index(r)).alias(f"{r}{end}") for r in POLICIES[policy] for end, f in (("", lambda b: F.count_if(under.bitwiseAND(F.lit(b)) != 0)), (":only", lambda b: F.count_if(under == b)))]
    one = rows.agg(F.count("*").alias("n"), F.count_if(under != 0).alias("rejected"), F.bit_or(under).alias("seen"), *sums)
    entries = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("failed"), F.col(f"`{r}:only`").alias("only"), F.col("n"), F.col("rejected")) for r in POLICIES[policy]))
    return one.select(F.inline(entries))


def report(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The query's columns, with the bits."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = ledger(docs, "doc_id").withColumn("base_failed", base)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & passes(policy)).alias("kept"), "bits"
    )
