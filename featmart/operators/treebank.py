"""TXT-1 in full: English word tokens by the published Penn Treebank conventions, as a chain of rewrite rules.

The text is taken line by line, a line being a sentence; a sentence end followed by a capital also ends a line. Each
rule is one ``regexp_replace`` over the whole text, in order, and the tokens are what stands between blanks at the end.
Spans that match ``protect`` (addresses, say) are cut out before the rules and come back as one token each.

Most rules change few texts. Where every match of a rule holds a plain string, the rule is only run over texts that hold
it, and the rules for words that are two only over texts in which one of them matches.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the rules of the published tokenizer, in their order -----------------------------
#: Pattern and replacement; ``\1`` names a group. Lines begin and end with ``\n``.
RULES = [
    # sentence ends inside a line
    (r"([.?!][\"')\]]*)[ \t]+([A-Z\"'(])", r"\1" + "\n" + r"\2"),
    # opening quotes
    ("\n\"", "\n`` "),
    (r"([ (\[{<])" + '"', r"\1 `` "),
    # punctuation
    (r"\.\.\.", " ... "),
    (r"([;@#$%&])", r" \1 "),
    (r"([:,])([^0-9])", r" \1 \2"),
    # a period is split at the end of the sentence only
    (r"([^.])(\.)([\])}>\"']*)[ \t]*" + "\n", r"\1 \2\3 " + "\n"),
    (r"([?!])", r" \1 "),
    # brackets and dashes
    (r"([\[\](){}<>])", r" \1 "),
    (r"--", " -- "),
    ("\n", " \n "),
    # closing quotes
    ('"', " '' "),
    (r"([^'])' ", r"\1 ' "),
    # endings after an apostrophe
    (r"'([sSmMdD]) ", r" '\1 "),
    (r"'(ll|LL|re|RE|ve|VE) ", r" '\1 "),
    (r"(n't|N'T) ", r" \1 "),
    # words that are two: see ``TWO_WORDS``
    (r"(?i) (can)(not) ", r" \1 \2 "),
    (r"(?i) (d)('ye) ", r" \1 \2 "),
    (r"(?i) (gim)(me) ", r" \1 \2 "),
    (r"(?i) (gon)(na) ", r" \1 \2 "),
    (r"(?i) (got)(ta) ", r" \1 \2 "),
    (r"(?i) (lem)(me) ", r" \1 \2 "),
    (r"(?i) (more)('n) ", r" \1 \2 "),
    (r"(?i) ('t)(is) ", r" \1 \2 "),
    (r"(?i) ('t)(was) ", r" \1 \2 "),
    (r"(?i) (wan)(na) ", r" \1 \2 "),
]
# -----------------------------------------------------------------------------------------------------
#: Strings of which every match of a pattern holds at least one.
HOLDS = {
    "\n\"": ["\n\""], r"([ (\[{<])" + '"': ['"'], r"\.\.\.": ["..."], r"([?!])": ["?", "!"], r"--": ["--"], '"': ['"'], r"([^'])' ": ["' "],
    r"'([sSmMdD]) ": ["'"], r"'(ll|LL|re|RE|ve|VE) ": ["'"], r"(n't|N'T) ": ["n't", "N'T"],
}
#: Matches where the first of the rules for words that are two matches; they are the last rules.
_TWO = [p for p, _ in RULES if p.startswith("(?i)")]
TWO_WORDS = "(?i)" + "|".join(p.removeprefix("(?i)") for p in _TWO)
_BLANKS = r"[ \n\t\r\x0b\x0c]+"


def rewritten(text: Column) -> Column:
    """``text`` after all rules: tokens with blanks between them."""
    out = F.concat(F.lit("\n"), text, F.lit("\n"))
    for pattern, replacement in RULES:
        if pattern in HOLDS:
            out = _where(out, lambda t, p=pattern: reduce(or_, (t.contains(h) for h in HOLDS[p])), [(pattern, replacement)])
        elif pattern not in _TWO:
            out = _replaced(out, pattern, replacement)
    return _where(out, lambda t: t.rlike(TWO_WORDS), [(p, r) for p, r in RULES if p in _TWO])


def _replaced(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, pattern, re.sub(r"\\([0-9])", r"$\1", replacement))


def _where(text: Column, condition: Callable[[Column], Column], rules: list[tuple[str, str]]) -> Column:
    """``text`` after ``rules`` where it meets ``condition``; ``text`` is worked out once."""
    def changed(t: Column) -> Column:
        return F.when(condition(t), reduce(lambda u, rule: _replaced(u, *rule), rules, t)).otherwise(t)

    return F.element_at(F.transform(F.array(text), changed), 1)


def _split(text: Column) -> Column:
    return F.filter(F.split(rewritten(text), _BLANKS), lambda t: t != "")


def treebank_tokens(text: Column | str, protect: str | None = None) -> Column:
    """The tokens of ``text`` in order; NULL or empty text has none. Matches of ``protect`` (a pattern without groups
    that matches no empty string) are tokens as they stand."""
    t = F.col(text) if isinstance(text, str) else text
    t = F.coalesce(t, F.lit(""))
    if protect is None:
        return _split(t)
    kept = F.transform(F.regexp_extract_all(t, F.lit(protect), F.lit(0)), lambda m: F.array(m))
    gaps = F.transform(F.split(t, protect, -1), _split)
    return F.flatten(F.zip_with(gaps, kept, lambda g, k: F.concat(g, F.coalesce(k, F.array().cast("array<string>")))))


def rewritten_sql(text: str) -> str:
    """The same chain in DuckDB SQL (used only for the oracles)."""
    out = f"(chr(10) || coalesce({text}, '') || chr(10))"

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    for pattern, replacement in RULES:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return out
