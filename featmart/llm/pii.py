"""Personal data: weak labelers vote on candidate spans, expectation-maximisation weighs them.

Candidates are the matches of the base patterns (valid or not) and of looser ones. Five labelers look
at each: written form, checksum or range, gazetteer of known prefixes and endings, cue words before
it, and what stands beside it. A vote is 1, -1 or 0 (abstains). From the number of candidates with
each combination of votes, expectation-maximisation estimates how reliable every labeler is and how
probable every combination makes personal data; these probabilities train a logistic classifier over
votes, kind and shape, which judges every candidate. A base match that passes its base check is
always reported, one that fails it never; the classifier adds looser candidates that overlap none of these.

All work on texts uses Spark's own functions. The driver sees one count for each combination of
votes, kind and shape, at most ``len(KINDS) * 3**5 * 4`` rows however large the table is.

Defined edge cases: a null or empty text has no spans; without candidates nothing is added; repeated
rows are judged each; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.llm.spans import apart, find, listing, luhn, packed_rows, replaced, tagged, unpacked

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "iban")
LABELERS = 5
ROUNDS = 60

# The base patterns, with possessive repeats and guards that leave the matches as they are.
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
# Looser forms, by kind.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]++"
              r"(?:\x20?(?:\.|[\[(]\x20?(?:dot|DOT)\x20?[\])])\x20?[A-Za-z0-9-]++)++", ("(", "[")),
    "phone": (r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", None),
    "id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "iban": (r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", None),
}
# Written forms, known prefixes and endings, and cue words.
FORM = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9-]+\.)+[A-Za-z]{2,}$",
    "ip": r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4})$",
    "phone": r"^(\+[0-9]{1,3}[ .-]?)?(\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}$",
    "id": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}( [A-Z0-9]{4}){3,7}( [A-Z0-9]{1,3})?$|^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$",
}
KNOWN = {
    "email": r"(?i)(\.|dot[\])]? ?)(com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|us|ch|at|pl|se)$",
    "ip": None,
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
    "id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE)",
}
CUES = {
    "email": "mail|contact|write to|reply|kontakt|correo",
    "ip": "\\bip\\b|host|server|address|client|gateway|login from",
    "card": "card|visa|master|amex|payment|karte|tarjeta|carte",
    "phone": "call|tel|phone|mobile|fax|whatsapp|sms",
    "id": "ssn|social|security|\\bid\\b|passport",
    "iban": "iban|account|konto|cuenta|compte|bank",
}
AGAINST = "version|isbn|issn|order|invoice|serial|sku|ticket|build|release|page"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets(value: Column) -> Column:
    return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")


def _mod97(value: Column) -> Column:
    """Remainder of an account number's check, digit by digit."""
    moved = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(moved, 5, 64), F.substring(moved, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(
        a * 100 + F.ascii(c) - 55) % 97)


def _valid(kind: str, value: Column) -> Column:
    """The base check of a match (for kinds without one: a checksum or range)."""
    n = F.length(_digits(value))
    return {"email": F.lit(True), "ip": _octets(value), "card": n.between(13, 19) & luhn(F.left(_digits(value), F.lit(20))),
            "phone": n.between(9, 15), "id": value.rlike("^(?!000|666|9)"), "iban": _mod97(value) == 1}[kind]


def _passes(kind: str):
    return lambda s: _valid(kind, s["value"])


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(F.lit(True) if no is None else no, -1).otherwise(0)


def _votes(kind: str, s: Column) -> Column:
    value, before = s["value"], F.lower(s["before"])
    check = {"email": _vote(value.rlike(r"[A-Za-z]{2,}$"), value.rlike("[0-9]$")),
             "phone": _vote(F.length(_digits(value)).between(10, 15))}.get(kind, _vote(_valid(kind, value)))
    known = F.lit(0) if KNOWN[kind] is None else _vote(value.rlike(KNOWN[kind]))
    if kind == "ip":
        known = _vote(F.lit(False), value.rlike(r"^0+\.|^127\.|^255\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    beside = _vote(~s["before"].rlike(r"[A-Za-z0-9_.@/-]$") & ~s["after"].rlike(r"[A-Za-z0-9_@/-]"))
    return F.array(_vote(value.rlike(FORM[kind])), check, known, _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)), beside)


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__base`` (array by kind of valid base spans) and ``__more`` (all other candidates
    with ``kind``, ``place``, ``votes`` and ``shape``)."""
    found = find(docs, text, {**{f"__b_{k}": p for k, p in PATTERNS.items()}, **{f"__l_{k}": p for k, p in LOOSE.items()}})
    found = found.withColumns({f"__v_{k}": F.filter(f"__b_{k}", _passes(k)) for k in BASE})

    def judged(kind: str, spans: Column, base: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), _votes(kind, s).alias("votes"),
            (F.when(F.length(s["value"]) > 18, 2).otherwise(0) + F.when(s["value"].rlike(r"[ .-]"), 1).otherwise(0)).alias("shape"),
            F.lit(base).alias("settled")))

    every = F.concat(*(judged(k, F.col(f"__b_{k}"), True) for k in BASE), *(judged(k, F.col(f"__l_{k}"), False) for k in LOOSE))
    base = F.concat(*(tagged(k, i, F.col(f"__v_{k}")) for i, k in enumerate(BASE)))
    return found.withColumns({"__base": base, "__every": every}).drop(
        *(f"__{x}_{k}" for x in "bv" for k in BASE), *(f"__l_{k}" for k in LOOSE))


def reliabilities(rows: list[tuple[int, tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over ``(kind, votes, count)``.

    Returns the probability of personal data for each row, the chance of each vote (-1, 0, 1) by class
    and labeler, and the share of personal data by kind. Labelers start as right four times in five;
    counts are smoothed by one.
    """
    kind = np.array([r[0] for r in rows])
    vote = np.array([r[1] for r in rows]) + 1
    count = np.array([r[2] for r in rows], dtype=float)
    chance = np.array([[[0.6, 0.25, 0.15]] * LABELERS, [[0.15, 0.25, 0.6]] * LABELERS])
    share = np.full(len(KINDS), 0.5)
    for _ in range(ROUNDS):
        log = [np.log(p)[kind] + sum(np.log(chance[c, j, vote[:, j]]) for j in range(LABELERS))
               for c, p in ((0, 1 - share), (1, share))]
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        for c, w in ((0, count * (1 - p)), (1, count * p)):
            for j in range(LABELERS):
                got = np.bincount(vote[:, j], weights=w, minlength=3) + 1
                chance[c, j] = got / got.sum()
        yes = np.bincount(kind, weights=count * p, minlength=len(KINDS)) + 1
        share = yes / (np.bincount(kind, weights=count, minlength=len(KINDS)) + 2)
    return p, chance, share


def _features(kind: int, votes: tuple[int, ...], shape: int) -> list[float]:
    return [1.0, *(float(kind == k) for k in range(len(KINDS))), *(float(v == s) for v in votes for s in (-1, 1)),
            float(shape >= 2), float(shape % 2)]


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Weights of the span classifier, trained on the votes on all candidates of ``docs``."""
    seen = (candidates(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), "text")
            .select(F.explode("__every").alias("c")).groupBy("c.place", "c.votes", "c.shape").count())
    rows = sorted((r.place, tuple(r.votes), r["shape"], r["count"]) for r in seen.collect())  # bounded, see above
    if not rows:
        return []
    total: dict[tuple, int] = {}
    for place, votes, _, n in rows:
        total[place, votes] = total.get((place, votes), 0) + n
    p = dict(zip(total, reliabilities([(*k, n) for k, n in total.items()])[0]))
    x = np.array([_features(k, v, s) for k, v, s, _ in rows])
    y = np.array([p[k, v] for k, v, _, _ in rows])
    n = np.array([r[3] for r in rows], dtype=float)
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(2000):  # logistic regression on soft labels, with a small penalty
        w -= 2.0 * (x.T @ (n * (1 / (1 + np.exp(-np.clip(x @ w, -50, 50))) - y)) + 1e-4 * w)
    return [float(v) for v in w]


def probability(weights: list[float], c: Column) -> Column:
    """The classifier's probability that candidate ``c`` is personal data."""
    first, rest = 1 + len(KINDS), weights[1 + len(KINDS):]
    z = F.lit(weights[0]) + F.element_at(F.array(*map(F.lit, weights[1:first])), c["place"] + 1)
    for j in range(LABELERS):
        v = c["votes"][j]
        z = z + F.when(v == -1, rest[2 * j]).when(v == 1, rest[2 * j + 1]).otherwise(0.0)
    z = z + F.when(c["shape"] >= 2, rest[-2]).otherwise(0.0) + F.when(c["shape"] % 2 == 1, rest[-1]).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def personal_data(docs: DataFrame, weights: list[float] | None = None, text_col: str = "text",
                  least: float = 0.5) -> DataFrame:
    """``docs`` with ``base`` (valid base spans) and ``spans`` (these and the added ones), both arrays of
    ``struct(start, place, end, kind)`` by kind and then start (columns of these names are replaced).
    Fits the classifier if not given."""
    weights = fit(docs, text_col) if weights is None else weights
    rows, names = packed_rows(docs, text_col, ("base", "spans"))
    return _judged(rows, weights, least).select(*unpacked(names), F.col("__base").alias("base"), F.col("__spans").alias("spans"))


def _judged(rows: DataFrame, weights: list[float], least: float) -> DataFrame:
    found = candidates(rows, "__text")
    if weights:
        extra = F.filter("__every", lambda c: ~c["settled"] & (probability(weights, c) >= least))
        extra = F.transform(extra, lambda c: F.struct(c["start"], c["place"], c["end"], c["kind"]))
    else:
        extra = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    found = found.withColumn("__extra", apart(extra, F.col("__base")))
    by_kind = F.transform(F.array_sort(F.transform(F.concat("__base", "__extra"), lambda s: F.struct(
        s["place"], s["start"], s["end"], s["kind"]))), lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"]))
    return found.withColumn("__spans", by_kind)


def redacted(docs: DataFrame, weights: list[float] | None = None, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in brackets; a null text stays null."""
    weights = fit(docs, text_col) if weights is None else weights
    rows, names = packed_rows(docs, text_col, ())
    found = _judged(rows, weights, least).withColumn("__by_start", F.array_sort("__spans"))
    new = F.when(F.col("__row").getField(text_col).isNotNull(), replaced(F.col("__text"), F.col("__by_start")))
    return found.select(*(new.alias(c) if c == text_col else col for c, col in zip(names, unpacked(names))))


__all__ = ["candidates", "fit", "listing", "personal_data", "probability", "redacted", "reliabilities"]
