"""Secret scans: fixed patterns, and a randomness test battery for other tokens.

DataFrame functions only.  Three patterns find assigned values, access keys and
hex strings.  Tokens are all other runs of ``LEAST`` or more characters of each
alphabet in ``RUNS``, so ``name=value`` and values joined by separators are
judged part by part as well as together; of tokens found one in another the
longest counts.  Each gets an encoding by its alphabet, and four p-values under
the hypothesis that its symbols are drawn evenly and independently: chi-squared
over symbols and over character classes, Wald-Wolfowitz runs of the alphabet's
halves, and lag-one serial correlation.  Four times the least of them is the
token's value.

Language, identifiers and paths fail the battery, secrets seldom do.  Which
tokens fail is decided by the Benjamini-Hochberg rule at level ``Q`` within
each encoding and length band, so the share of secrets among the discarded
tokens is bounded for short and long tokens alike.  Tokens too short for their
alphabet (``ENCODINGS``) to fail these tests have bands of their own and a fifth
test, five times the least being their value: the log-likelihood ratio of their
letters between common ``FREQUENCIES`` and even ones.  At a p-value of 0.05 it
rejects 95 of 100 tokens of 20 letters drawn with those frequencies (82 of 14
letters) and, alone, one even token of a hundred.  The rule
reads a histogram of all p-values of the corpus, of bounded size.

Null and empty texts have no spans; a null doc_id is carried along; repeated
rows are separate documents; an empty table gives an empty result.  Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
#: The base patterns (fixed values).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
LEAST = 20
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Maximal runs of base64, of its form for URLs, of letters and digits, and of all symbols.
RUNS = tuple(f"(?<![{a}])[{a}]{{20,}}=*" for a in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9", "A-Za-z0-9+/_-"))
#: (pattern, alphabet, length from which four tests suffice), the narrowest alphabet first, all symbols last.
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef", 20),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF", 20),
    (r"^[a-z]+$", LOWER, 60),
    (r"^[A-Z]+$", UPPER, 60),
    (r"^[A-Z2-7]+=*$", UPPER + "234567", 32),
    (r"^[a-z0-9]+$", LOWER + DIGITS, 24),
    (r"^[A-Z0-9]+$", UPPER + DIGITS, 24),
    (r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/", 24),
    (r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_", 24),
    (r"^[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/-_", 24),
)
#: Of a to z in text, in percent.
FREQUENCIES = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.15, 2.0, 0.07)
#: Log ratios to even letters, the rarest ones cut so that other languages fail too; their mean and deviation where letters are even.
LETTERS = [max(-1.5, math.log(0.26 * f)) for f in FREQUENCIES]
LETTER_MEAN = sum(LETTERS) / 26
LETTER_DEV = math.sqrt(sum((x - LETTER_MEAN) ** 2 for x in LETTERS) / 26)
Q = 0.05
#: Steps of the p-value histogram to a factor of ten, and the smallest exponent told apart.
STEPS, DEEPEST = 40, 40
_SPAN = "array<struct<start:int,kind:int,end:int,body:string>>"


def _spans(found: str, gaps: str, kind: int) -> Column:
    """Matches with their places: what stands between the matches gives the offsets."""
    pairs = F.arrays_zip(F.col(found).alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["m"])
        here = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("body"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    every = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, every).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; a plain column would be, anew, at each use inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tail(z: Column) -> Column:
    """Two-sided normal p-value, by a rational bound of Mills' ratio (relative error under one in a thousand)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), F.greatest(F.lit(1e-300), 2 * 0.3989422804014327 * F.exp(-a * a / 2) * poly))


def _chi(x: Column, df: Column) -> Column:
    """Two-sided p-value of a chi-squared statistic, by the Wilson-Hilferty root."""
    c = 2 / (9 * df)
    return _tail((F.pow(x / df, F.lit(1 / 3)) - (1 - c)) / F.sqrt(c))


def _case(encoding: Column, values: list) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), encoding)


def battery(tokens: Column) -> Column:
    """Of spans: (start, kind, end, body, encoding from 1, band, p) of those that can be judged."""
    bare = lambda t: F.regexp_replace(t, "=+$", "")

    def named(t: Column) -> Column:
        which = F.coalesce(*(F.when(t["body"].rlike(p), F.lit(i + 1)) for i, (p, *_) in enumerate(ENCODINGS)), F.lit(0))
        return F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), bare(t["body"]).alias("body"), which.alias("encoding"))

    def placed(t: Column) -> Column:
        alphabet = _case(t["encoding"], [a for _, a, _ in ENCODINGS])
        at = F.transform(F.split(t["body"], ""), lambda c: F.instr(alphabet, c))
        return F.struct(t.alias("t"), F.char_length(t["body"]).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"), alphabet.alias("alphabet"), at.alias("at"))

    def tested(s: Column) -> Column:
        n, k, body = s["n"], s["k"], s["t"]["body"]
        total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
        symbols = F.transform(F.split(s["alphabet"], ""), lambda c: F.pow(n - F.char_length(F.replace(body, c, F.lit(""))), F.lit(2)))
        even = total(symbols) * k / n - n
        sizes = [F.length(F.regexp_replace(s["alphabet"], f"[^{c}]", "")).cast("double") for c in ("a-z", "A-Z", "0-9")]
        counts = [n - F.char_length(F.translate(body, c, "")) for c in (LOWER, UPPER, DIGITS)]
        parts = [F.when(m > 0, F.pow(c - n * m / k, F.lit(2)) / (n * m / k)).otherwise(F.lit(0.0)) for m, c in zip(sizes, counts, strict=True)]
        groups = sum((F.when(m > 0, 1).otherwise(0) for m in sizes[1:]), F.when(sizes[0] > 0, 1).otherwise(0))
        high = F.transform(s["at"], lambda i: (i * 2 > k).cast("int"))
        return F.struct(
            s["t"].alias("t"), n.alias("n"), k.alias("k"), s["at"].alias("at"), high.alias("high"), even.alias("even"),
            (parts[0] + parts[1] + parts[2]).alias("classes"), groups.alias("groups"),
            (total(F.transform(s["at"], lambda i: i.cast("double"))) / n).alias("mean"),
            F.aggregate(high, F.lit(0), lambda a, v: a + v).cast("double").alias("above"),
            (n < _case(s["t"]["encoding"], [m for *_, m in ENCODINGS])).alias("short"), body.alias("body"),
        )

    def judged(s: Column) -> Column:
        n, at, high = s["n"], s["at"], s["high"]
        total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
        steps = F.sequence(F.lit(1), s["n"].cast("int") - 1)
        runs = total(F.transform(steps, lambda i: (F.element_at(high, i) != F.element_at(high, i + 1)).cast("double"))) + 1
        up, down = s["above"], n - s["above"]
        expected = 2 * up * down / n + 1
        spread = 2 * up * down * (2 * up * down - n) / (n * n * (n - 1))
        # all in one half: as unlikely as n equal coins
        p_runs = F.when((up == 0) | (down == 0), F.greatest(F.lit(1e-300), 2 * F.exp(-n * 0.6931471805599453))).otherwise(F.when(spread > 0, _tail((runs - expected) / F.sqrt(spread))).otherwise(F.lit(1.0)))
        across = total(F.transform(steps, lambda i: (F.element_at(at, i) - s["mean"]) * (F.element_at(at, i + 1) - s["mean"])))
        within = total(F.transform(at, lambda i: F.pow(i - s["mean"], F.lit(2))))
        p_serial = F.when(within > 0, _tail((across / within + 1 / n) * F.sqrt(n))).otherwise(F.lit(1e-300))
        p_classes = F.when(s["groups"] > 1, _chi(s["classes"], F.greatest(s["groups"] - 1, F.lit(1)).cast("double"))).otherwise(F.lit(1.0))
        # too even over classes is no sign of language: only the upper side counts there
        p_classes = F.when(s["classes"] <= s["groups"], F.lit(1.0)).otherwise(p_classes)
        p = F.least(F.lit(1.0), 4 * F.least(_chi(s["even"], s["k"] - 1), p_classes, p_runs, p_serial))
        low = F.when(s["short"], F.lower(s["body"])).otherwise(F.lit("-"))
        small = F.transform(F.split(low, ""), lambda c: F.element_at(F.array(*map(F.lit, [0.0, *LETTERS])), F.instr(F.lit(LOWER), c) + 1))
        m = (F.char_length(low) - F.char_length(F.translate(low, LOWER, ""))).cast("double")
        z = (total(small) - m * LETTER_MEAN) / (LETTER_DEV * F.sqrt(m))
        p_letters = F.when((m > 0) & (z > 0), _tail(z) / 2).otherwise(F.lit(1.0))
        p = F.when(s["short"], F.least(F.lit(1.0), 1.25 * p, 5 * p_letters)).otherwise(p)
        t = s["t"]
        band = (F.least(F.lit(7), F.floor(F.log2(n / LEAST) * 2)) + F.when(s["short"], 8).otherwise(0)).cast("int")
        return F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), t["encoding"].alias("encoding"), band.alias("band"), p.alias("p"))

    enough = lambda t: (t["encoding"] > 0) & (F.char_length(t["body"]) >= LEAST)
    ready = F.filter(F.transform(tokens, named), enough)
    return F.transform(F.transform(F.transform(ready, placed), tested), judged)


def _located(docs: DataFrame, *others: str) -> DataFrame:
    """Base spans, and judged tokens outside them.

    A cheap look at the text comes before each pattern; most texts hold none.
    """
    text, low = F.col("_text"), F.lower("_text")
    named = F.contains(low, F.lit("token"))
    for word in ("secret", "passw", "api"):
        named = named | F.contains(low, F.lit(word))
    named = named | text.rlike(r"[\u0130\u212A\u017F]")  # lower() changes these otherwise
    looks = (named, F.contains(text, F.lit("AKIA")), text.rlike(HEX), *[text.rlike(TOKEN)] * len(RUNS))
    patterns = (ASSIGN, ACCESS, HEX, *RUNS)
    none = F.expr("cast(array() as array<string>)")
    found = docs.select(*others, F.coalesce("text", F.lit("")).alias("_text"))
    found = found.select("*", *(F.when(look, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f"_m{k}") for k, (look, p) in enumerate(zip(looks, patterns, strict=True))))
    found = found.select("*", *(F.when(F.size(f"_m{k}") > 0, F.split(text, p, -1)).alias(f"_g{k}") for k, p in enumerate(patterns)))
    spans = [_spans(f"_m{k}", f"_g{k}", min(k, 3)) for k in range(len(patterns))]
    spans[0] = F.filter(spans[0], lambda s: F.char_length(F.regexp_extract(s["body"], ASSIGN, 2)) >= 6)
    spans[3:] = [F.array_sort(F.concat(*spans[3:]))]
    found = found.select(*others, "_text", f"_m{len(patterns) - 1}", *(c.alias(n) for c, n in zip(spans, ("_assign", "_access", "_hex", "_tokens"), strict=True)))
    apart = lambda a: F.filter(a, lambda t, i: (i == 0) | (t["start"] != F.get(a, i - 1)["start"]) | (t["end"] != F.get(a, i - 1)["end"]))
    # every token lies in a run of all symbols
    found = found.withColumn("_tokens", F.when(F.size(f"_m{len(patterns) - 1}") > 0, _let(F.col("_tokens"), apart)))
    found = found.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    both = F.struct(F.col("_base").alias("base"), F.col("_tokens").alias("tokens"))
    free = _let(both, lambda s: F.filter(s["tokens"], lambda t: ~F.exists(s["base"], lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    found = found.withColumn("_free", F.when(F.size("_tokens") > 0, free))
    return found.withColumn("_judged", F.when(F.size("_free") > 0, battery(F.col("_free"))))


def thresholds(docs: DataFrame) -> dict[tuple[int, int], float]:
    """Greatest p-value that counts as not random, of each encoding and band with any (at most 160)."""
    tokens = _located(docs).select(F.explode("_judged").alias("t")).select("t.encoding", "t.band", "t.p")
    step = F.least(F.lit(STEPS * DEEPEST), F.ceil(-F.log10("p") * STEPS)).cast("int")  # p is at most 10 ** -((step - 1) / STEPS)
    counts = tokens.groupBy("encoding", "band", step.alias("step")).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rank", F.expr("sum(n) OVER (PARTITION BY encoding, band ORDER BY step DESC)"))
    ranked = ranked.withColumn("all", F.expr("sum(n) OVER (PARTITION BY encoding, band)"))
    edge = F.pow(F.lit(10.0), -(F.col("step") - 1) / STEPS)
    cut = ranked.where(edge <= F.col("rank") * Q / F.col("all")).groupBy("encoding", "band").agg(F.max(edge).alias("edge"))
    return {(r["encoding"], r["band"]): r["edge"] for r in cut.collect()}


def _outermost(spans: Column) -> Column:
    """Spans that stand in no other one: in order, the longer first, those that end behind all before them."""
    ordered = F.array_sort(F.transform(spans, lambda t: F.struct(t["start"].alias("start"), (-t["end"]).alias("back"), t["kind"].alias("kind"))))
    start = F.struct(F.lit(-1).alias("reach"), F.expr(f"cast(array() as {_SPAN})").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        here = F.struct(t["start"].alias("start"), t["kind"].alias("kind"), (-t["back"]).alias("end"), F.lit("").alias("body"))
        out = F.when(-t["back"] > acc["reach"], F.concat(acc["out"], F.array(here))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["reach"], -t["back"]).alias("reach"), out.alias("out"))

    return F.aggregate(ordered, start, step, lambda acc: acc["out"])


def find(docs: DataFrame, *others: str) -> DataFrame:
    """The ``others`` columns of every row with ``_text``, ``_assign``, ``_access``, ``_hex``, ``_base`` and ``_spans`` (all kinds, in order)."""
    cuts = thresholds(docs)
    located = _located(docs, *others)
    entries = [v for (e, b), p in cuts.items() for v in (F.lit(e * 100 + b), F.lit(float(p)))]
    limit = F.create_map(*entries) if entries else F.expr("cast(map() as map<int,double>)")
    random = F.filter("_judged", lambda t: t["p"] > F.coalesce(F.element_at(limit, t["encoding"] * 100 + t["band"]), F.lit(0.0)))
    located = located.withColumn("_random", random)
    extra = _outermost(F.col("_random"))
    spans = F.when(F.col("_judged").isNull(), F.col("_base")).otherwise(F.array_sort(F.concat("_base", extra)))
    return located.withColumn("_spans", spans)


def _joined(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """The query's columns: counts, a digest of the base spans, and all spans."""
    found = find(docs, "doc_id")
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("_spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced, and ``n_chars`` counted again; columns as they were.

    A null text stays null and its ``n_chars`` as it is; columns of any name are carried along.
    """
    names = docs.columns
    held = docs.select(*(F.col(f"`{c}`").alias(c if c == "text" else f"c{i}") for i, c in enumerate(names)), F.col("text").isNull().alias("absent"))
    found = find(held, "absent", *(c for c in held.columns if c not in ("text", "absent")))
    text = F.col("_text")

    def step(acc: Column, s: Column) -> Column:
        before = F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.when(s["start"] >= acc["at"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), before.alias("out"))

    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    done = F.when(F.size("_spans") > 0, done).otherwise(text)
    found = found.withColumn("_done", F.when(~F.col("absent"), done))
    chars = {"n_chars": lambda c: F.when(F.col("absent"), c).otherwise(F.char_length("_done").cast("long"))}
    return found.select(*((F.col("_done") if c == "text" else chars.get(c, lambda x: x)(F.col(f"c{i}"))).alias(c) for i, c in enumerate(names)))
