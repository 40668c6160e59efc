"""Personal data by weak supervision, in DataFrame functions throughout.

Patterns propose spans. Those of the base kinds (email, ip, card, phone) that pass
their check are personal data as they stand. Further patterns propose spans that no
base span touches: written-out addresses, cards and phones that a longer run of
digits hides from the base patterns, identity numbers, bank accounts, names with a
title. Which of these count is learned without labels:

1. Labelers vote yes, no or nothing on every proposed span, base ones and failed
   ones included: regular expressions (form, checksum, shape), gazetteers (domains,
   calling codes, issuers, countries, first names) and context (words before it
   that speak for or against it, what it is glued to).
2. Expectation-maximisation estimates how often each labeler says yes of personal
   data and of other spans (checksums are trusted as they are), and how common
   personal data is in each kind. Spans
   with the same votes and features are one row with a count, so an iteration reads
   a table whose size does not depend on the corpus: one pass over the texts.
3. A logistic classifier over votes, kind and features of the span is trained on
   the resulting probabilities (Boehning's bound instead of the Hessian) and decides.

A base pattern's matches are leftmost and do not overlap; a match that fails its
check is dropped and nothing inside it is tried by that pattern again. The patterns
here are the same matches written without backtracking, so long runs cost linear
time. Spans count code points, the end is exclusive; of spans proposed at the same
place by several patterns the first kind listed keeps it.

Defined cases: a null text is empty and has no span; empty texts likewise; very
long texts are searched whole; repeated rows are judged each; null keys are kept;
an empty table, or one without any proposal, learns nothing and gives base spans
alone; other columns never enter.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national_id", "iban", "person")
BEFORE, AFTER = 24, 2  # code points of context
LEAST_DIGITS = 7  # a failed match with fewer (a year, a count) is no proposal
EM_ROUNDS, FIT_ROUNDS, RIDGE = 15, 20, 0.5

# What the gazetteers list.
DOMAINS = "com org net edu gov info biz io int eu de fr es uk it nl be at ch pl pt se no dk fi us ca au nz jp cn in br mx ar ru".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420".split()
ACCOUNTS = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora".split()
NAMES = ("James John Robert Michael David Mary Linda Susan Sarah Anna Peter Thomas Martin Klaus Hans Stefan Sabine Monika Jean Pierre Marie "
         "Claire Luc Sophie Carlos José Juan Luis Carmen Ana Lucía Pedro Elena Paul Laura Julia Maria Daniel").split()
FOR_WORDS = {
    "email": "mail contact write reply cc from", "ip": "ip host addr address client server peer", "card": "card visa mastercard credit pay karte carte tarjeta",
    "phone": "phone tel call fax mobile cell telefon téléphone teléfono", "national_id": "ssn social security id", "iban": "iban account konto compte cuenta bank",
    "person": "name contact from signed dear",
}
AGAINST_WORDS = "version release build rev section isbn issn order invoice ticket serial sku part commit hash checksum example".split()

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# What a run starts with decides about the run, so only starts (or what a match
# has left of one) are tried; possessive loops neither go back nor recurse.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MORE = {
    "email": (rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(] ?at ?[\])] ?{_LABEL}++(?: ?[\[(] ?dot ?[\])] ?{_LABEL}++)++",),
    "ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",),
    "card": (r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",),
    "phone": (r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])", r"\+[0-9]{1,3}[ .-][0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{4}(?![0-9])"),
    "national_id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",),
    "person": (rf"(?<![\p{{L}}])(?:{'|'.join(TITLES)})\.? \p{{Lu}}\p{{Ll}}++(?: \p{{Lu}}\p{{Ll}}++)?",),
}
# A text without this holds no match.
_NEEDS = {"email": "@", "phone": "+"}

LABELERS = ("form", "checksum", "shape", "gazetteer", "for", "against", "apart")
# What is expected of each before any span is seen (yes of personal data, yes of
# other spans) and how many spans that expectation weighs.
EXPECTED = {"form": (0.95, 0.1), "shape": (0.8, 0.4), "gazetteer": (0.8, 0.4), "for": (0.9, 0.5), "against": (0.05, 0.5), "apart": (0.8, 0.5)}
EXPECTED_WEIGHT = 20
# A checksum is arithmetic, not opinion: its rates stay as expected. (Estimated
# freely, they drift: well-formed numbers with a wrong checksum look more like the
# right ones than like stray digits, and pull the rates after them.)
TRUSTED = {"checksum": (0.995, 0.05)}
# Codes of votes, kinds and features in one list.
NO, YES = 0, 1
_VOTES = 2 * len(LABELERS)
_KIND = _VOTES
FEATURES = ("few_digits", "some_digits", "many_digits", "separated", "after_letter", "before_letter")
_FEATURE = _KIND + len(KINDS)
CODES = _FEATURE + len(FEATURES)

_PROPOSED = "array<struct<start:int,end:int,m:string,before:string,after:string>>"


def _located(text: Column, matches: Column, pattern: str) -> Column:
    """The matches with their places and context; the text is cut between them."""
    n = F.size(matches)
    pieces = F.split(text, pattern, -1)
    cut = F.arrays_zip(F.slice(pieces, F.lit(1), n).alias("p"), matches.alias("m"), F.slice(pieces, F.lit(2), n).alias("q"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_PROPOSED).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.char_length(x["p"])
        b = a + F.char_length(x["m"])
        found = F.struct(a.alias("start"), b.alias("end"), x["m"].alias("m"), F.right(x["p"], F.lit(BEFORE)).alias("before"), F.left(x["q"], F.lit(AFTER)).alias("after"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    return F.when(n > 0, F.aggregate(cut, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(_PROPOSED))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Of a string of digits."""
    each = F.transform(F.split(F.reverse(number), ""), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of a bank account."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _card(m: Column) -> Column:
    return F.length(digits(m)).between(16, 19) & luhn(digits(m))


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.rlike(m, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
    "card": _card,
    "phone": lambda m: F.length(digits(m)).between(8, 15),
}


def _any(words) -> str:
    return rf"(?i)(?:^|[^\p{{L}}])(?:{'|'.join(words)})[^\p{{L}}]{{0,6}}$"


def _by_kind(kind: Column, votes: dict[str, Column]) -> Column:
    """The vote of the span's kind; null where it has none."""
    return reduce(lambda c, kv: F.when(kind == kv[0], kv[1]).otherwise(c), votes.items(), F.lit(None).cast("boolean"))


def _votes(c: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: true, false or null."""
    kind, m, before, after = c["kind"], c["m"], c["before"], c["after"]
    like = lambda pattern: F.rlike(m, F.lit(pattern))
    first_part = F.regexp_extract(m, r"^\+([0-9]{1,3})", 1)
    calling = reduce(lambda a, b: a | b, [F.startswith(first_part, F.lit(x)) for x in CALLING])
    word = {k: F.when(F.rlike(before, F.lit(_any(w.split()))), True) for k, w in FOR_WORDS.items()}
    touched = F.rlike(F.right(before, F.lit(1)), F.lit(r"[\p{L}0-9_=/-]")) | F.rlike(F.left(after, F.lit(1)), F.lit(r"[\p{L}0-9_=/]"))
    return {
        "form": _by_kind(kind, {
            "email": like(rf"^[A-Za-z0-9].*@.*\.[A-Za-z]{{2,}}$|at"), "ip": CHECKS["ip"](m) | F.contains(m, F.lit(":")), "card": F.length(digits(m)).between(16, 19),
            "phone": F.length(digits(m)).between(8, 15), "national_id": ~like("^(?:000|666|9)|-00-|0000$"), "iban": F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34),
            "person": like(r"\p{Lu}\p{Ll}+$")}),
        "checksum": _by_kind(kind, {"card": luhn(digits(m)), "iban": mod97(m)}),
        "shape": _by_kind(kind, {
            "email": F.length(m) <= 80, "ip": ~like(r"(?:^|\.)0[0-9]"), "card": like(r"^[0-9]{16,19}$|^(?:[0-9]{4}[ -]){3}[0-9]{4}$"), "phone": like(r"^\+[0-9]{1,3}[ .(-]"),
            "iban": like("^(?:[A-Z0-9]{4} )+[A-Z0-9]{1,4}$|^[A-Z0-9]+$"), "person": like(r"^\S+ \p{Lu}")}),
        "gazetteer": _by_kind(kind, {
            "email": F.when(F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(DOMAINS), True), "ip": ~like(r"^(?:0+|127|25[0-5]|2[4-9][0-9])\."),
            "card": like("^[3-6]"), "phone": calling, "iban": F.substring(m, 1, 2).isin(ACCOUNTS),
            "person": F.when(F.exists(F.split(m, " "), lambda w: w.isin(NAMES)), True)}),
        "for": _by_kind(kind, word),
        "against": F.when(F.rlike(before, F.lit(_any(AGAINST_WORDS))), True),
        "apart": ~touched,
    }


def _codes(c: Column) -> Column:
    """Votes, kind and features of a span as a sorted list of codes."""
    votes = [F.when(v, 2 * j + YES).when(~v, 2 * j + NO) for j, v in enumerate(_votes(c).values())]
    kind = F.array_position(F.array(*map(F.lit, KINDS)), c["kind"]).cast("int") - 1 + _KIND
    n = F.length(digits(c["m"]))
    features = [(n > 0) & (n < 16), n.between(16, 19), n > 19, F.rlike(c["m"], F.lit("[ ().-]")),
                F.rlike(c["before"], F.lit(r"\p{L}$")), F.rlike(c["after"], F.lit(r"^\p{L}"))]
    return F.array_compact(F.array(*votes, kind, *[F.when(f, _FEATURE + i) for i, f in enumerate(features)]))


def proposals(docs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The written spans of each row: keys and ``spans`` of (kind, start, end,
    base, more, codes). A base span has passed its check; one that is neither
    base nor more only serves the estimates."""
    text = F.coalesce("text", F.lit(""))
    searched = [(k, k, PATTERNS[k]) for k in BASE] + [(k, f"{k}_{i}", p) for k in KINDS for i, p in enumerate(MORE[k])]
    found = docs.select(*keys, text.alias("text"))
    wanted = lambda name, p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
    need = lambda k, name, c: F.when(F.contains("text", F.lit(_NEEDS[k])), c).otherwise(F.array().cast("array<string>")) if name in _NEEDS else c
    found = found.select(*keys, "text", *[need(k, name, wanted(name, p)).alias(f"m_{name}") for k, name, p in searched])
    found = found.select(*keys, *[_located(F.col("text"), F.col(f"m_{name}"), p).alias(f"s_{name}") for _, name, p in searched])

    def shaped(kind: str, name: str, base: Callable[[Column], Column], more: bool) -> Column:
        return F.transform(f"s_{name}", lambda c: F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), base(c["m"]).alias("base"),
                                                           F.lit(more).alias("more"), c["m"].alias("m"), c["before"].alias("before"), c["after"].alias("after")))

    first = F.concat(*[shaped(k, k, CHECKS[k], False) for k in BASE])
    second = F.concat(*[shaped(k, n, lambda m: F.lit(False), True) for k, n, _ in searched if n != k])
    both = found.select(*keys, first.alias("first"), second.alias("second"))
    sure = F.filter("first", lambda c: c["base"])
    touches = lambda c: F.exists("sure", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    # Of equal places the first kind keeps it; a failed match that is proposed again serves once.
    place = lambda c: F.struct(c["start"].alias("a"), c["end"].alias("b"))
    again = lambda c, i: F.exists(F.slice("second", F.lit(1), i), lambda d: place(d) == place(c))
    both = both.withColumn("sure", sure).withColumn("second", F.filter("second", lambda c, i: ~touches(c) & ~again(c, i)))
    failed = F.filter("first", lambda c: ~c["base"] & ~touches(c) & (F.length(digits(c["m"])) >= LEAST_DIGITS) & ~F.exists("second", lambda d: place(d) == place(c)))
    spans = both.select(*keys, F.concat("sure", "second", failed).alias("spans"))
    coded = F.transform("spans", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"),
                                                    c["more"].alias("more"), _codes(c).alias("codes")))
    return materialize(spans.select(*keys, coded.alias("spans")), "pii-spans")


# --------------------------------------------------------------- learning --

def _logit(codes, weights) -> Column:
    at = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(F.transform(codes, lambda c: F.get(at, c)), F.lit(0.0), lambda acc, w: acc + w)


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def patterns(spans: DataFrame) -> DataFrame:
    """(codes, n): spans that look alike to labelers and classifier. How many
    there are is bounded by the codes, not by the corpus, so one task holds them."""
    return materialize(spans.select(F.explode("spans.codes").alias("codes")).groupBy("codes").agg(F.count("*").alias("n")).coalesce(1), "pii-patterns").coalesce(1)


def _sums(seen: DataFrame, *values: Column) -> dict[int, list[float]]:
    """Sums of ``values`` over the spans that have each code (a row per code)."""
    each = seen.select(F.explode("codes").alias("code"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    got = each.groupBy("code").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(len(values))]).collect()
    return {r["code"]: [round(r[f"v{i}"], 6) for i in range(len(values))] for r in got}


def estimate(seen: DataFrame, rounds: int = EM_ROUNDS) -> tuple[list[float], dict[str, tuple[float, float]]]:
    """Weights of votes and kinds whose sum is the log odds of personal data, and
    each labeler's (yes of personal data, yes of others)."""
    rate, common = {name: (EXPECTED | TRUSTED)[name] for name in LABELERS}, dict.fromkeys(KINDS, 0.5)
    odds = lambda p: math.log(p / (1 - p))

    def weights() -> list[float]:
        votes = [math.log(x) for a, b in rate.values() for x in ((1 - a) / (1 - b), a / b)]
        return votes + [odds(common[k]) for k in KINDS] + [0.0] * len(FEATURES)

    for _ in range(rounds):
        p = _sigmoid(_logit("codes", weights()))
        got = _sums(seen, F.col("n") * p, F.col("n") * (1 - p))
        for j, name in enumerate(LABELERS):
            if name in TRUSTED:
                continue
            no, yes = got.get(2 * j + NO, [0, 0]), got.get(2 * j + YES, [0, 0])
            rate[name] = tuple((yes[i] + EXPECTED_WEIGHT * EXPECTED[name][i]) / (yes[i] + no[i] + EXPECTED_WEIGHT) for i in (0, 1))
        for i, k in enumerate(KINDS):
            with_, without = got.get(_KIND + i, [0, 0])
            common[k] = (with_ + 1) / (with_ + without + 2)
    return weights(), rate


def fit(seen: DataFrame, labels: list[float], rounds: int = FIT_ROUNDS) -> list[float]:
    """Weights of the classifier, trained on the probabilities ``labels`` give."""
    pairs = seen.select("n", F.explode("codes").alias("i"), "codes").select("n", "i", F.explode("codes").alias("j"))
    bound = np.eye(CODES) * RIDGE
    for r in pairs.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # at most CODES x CODES rows
        bound[r["i"], r["j"]] += r["n"] / 4
    inverse, w = np.linalg.inv(bound), np.zeros(CODES)
    truth = _sigmoid(_logit("codes", labels))
    for _ in range(rounds):
        slope = -RIDGE * w
        for code, (v,) in _sums(seen, F.col("n") * (truth - _sigmoid(_logit("codes", w)))).items():
            slope[code] += v
        w = np.round(w + inverse @ slope, 9)
    return [float(x) for x in w]


def find_personal_data(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Keys and ``spans`` of (kind, start, end, base, score) of ``docs`` (keys,
    text), by kind as listed, then start; score is 1 for base spans."""
    spans = proposals(docs, keys)
    seen = patterns(spans)
    weights = fit(seen, estimate(seen)[0]) if not seen.isEmpty() else [0.0] * CODES
    score = lambda c: F.when(c["base"], 1.0).otherwise(_sigmoid(_logit(c["codes"], weights)))
    rank = lambda c: F.array_position(F.array(*map(F.lit, KINDS)), c["kind"])
    judged = F.transform(F.filter("spans", lambda c: c["base"] | c["more"]), lambda c: F.struct(
        rank(c).alias("rank"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base"), score(c).alias("score")))
    kept = F.array_sort(F.filter(judged, lambda c: c["base"] | (c["score"] >= 0.5)))
    return spans.select(*keys, F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
                                                                    c["base"].alias("base"), c["score"].alias("score"))).alias("spans"))


def _joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


QUERIES = {"op12_pii": op12_pii}
