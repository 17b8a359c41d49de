"""Ordered keyword mappings (STR-3/4/5): the first matching rule wins, so rule order is semantics.

The rules are data (a list of ``(needles, label)``); ``apply_rules`` turns them into one ``CASE WHEN``
chain of ``contains`` tests that Spark code-generates -- no join, no Python per row. ``label=None``
means "keep the input value".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from featmart.functions.scalar import col_, lower_or_nan

__all__ = ["BROWSER_EXACT", "BROWSER_RULES", "ADCONTENT_RULES", "SOURCE_RULES", "apply_rules",
           "browser_family", "adcontent_group", "source_group", "rules_table"]

# --- fixed values (must equal the reference's mapping tables; order is significant) -------------
BROWSER_EXACT = ["chrome", "safari", "firefox", "internet explorer", "edge", "opera", "coc coc",
                 "maxthon", "iron"]
BROWSER_RULES = [
    (["android", "samsung", "mini", "iphone", "in-app", "playstation"], "mobile browser"),
    (["mozilla", "chrome", "blackberry", "nokia", "browser", "amazon"], "mobile browser"),
    (["lunascape", "netscape", "blackberry", "konqueror", "puffin", "amazon"], "mobile browser"),
    (["(not set)"], None),
]
ADCONTENT_RULES = [
    (["google"], "google"),
    (["placement", "placememnt"], "placement"),
    (["(not set)", "nan"], None),
    (["ad"], "ad"),
]
SOURCE_RULES = [
    (["google"], "google"), (["youtube"], "youtube"), (["(not set)", "nan"], None),
    (["yahoo"], "yahoo"), (["facebook"], "facebook"), (["reddit"], "reddit"), (["bing"], "bing"),
    (["quora"], "quora"), (["outlook"], "outlook"), (["linkedin"], "linkedin"),
    (["pinterest"], "pinterest"), (["ask"], "ask"), (["siliconvalley"], "siliconvalley"),
    (["lunametrics"], "lunametrics"), (["amazon"], "amazon"), (["mysearch"], "mysearch"),
    (["qiita"], "qiita"), (["messenger"], "messenger"), (["twitter"], "twitter"), (["t.co"], "t.co"),
    (["vk.com"], "vk.com"), (["search"], "search"), (["edu"], "edu"), (["mail"], "mail"),
    (["ad"], "ad"), (["golang"], "golang"), (["direct"], "direct"), (["dealspotr"], "dealspotr"),
    (["sashihara"], "sashihara"), (["phandroid"], "phandroid"), (["baidu"], "baidu"), (["mdn"], "mdn"),
    (["duckduckgo"], "duckduckgo"), (["seroundtable"], "seroundtable"), (["metrics"], "metrics"),
    (["sogou"], "sogou"), (["businessinsider"], "businessinsider"), (["github"], "github"),
    (["gophergala"], "gophergala"), (["yandex"], "yandex"), (["msn"], "msn"), (["dfa"], "dfa"),
    (["(not set)"], "(not set)"), (["feedly"], "feedly"), (["arstechnica"], "arstechnica"),
    (["squishable"], "squishable"), (["flipboard"], "flipboard"), (["t-online.de"], "t-online.de"),
    (["sm.cn"], "sm.cn"), (["wow"], "wow"), (["baidu"], "baidu"), (["partners"], "partners"),
]
OTHERS = "others"
# -------------------------------------------------------------------------------------------------


def apply_rules(x: Column, rules, default: str = OTHERS, exact: list[str] | None = None) -> Column:
    """First-match-wins mapping of text ``x`` (already normalised) by substring rules."""
    expr = None
    if exact:
        expr = F.when(x.isin(*exact), x)
    for needles, label in rules:
        cond = None
        for nd in needles:
            c = x.contains(nd)
            cond = c if cond is None else (cond | c)
        out = x if label is None else F.lit(label)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(F.lit(default))


def browser_family(c: Column | str) -> Column:
    """STR-3 on ``str(x).lower()``."""
    return apply_rules(lower_or_nan(col_(c)), BROWSER_RULES, exact=BROWSER_EXACT)


def adcontent_group(c: Column | str) -> Column:
    """STR-4 on ``str(x).lower()``."""
    return apply_rules(lower_or_nan(col_(c)), ADCONTENT_RULES)


def source_group(c: Column | str) -> Column:
    """STR-5 on ``str(x).lower()``."""
    return apply_rules(lower_or_nan(col_(c)), SOURCE_RULES)


def rules_table(rules) -> list[tuple[int, str, str | None]]:
    """Flatten rules to ``(priority, needle, label)`` rows (for reports and SQL oracles)."""
    out = []
    for i, (needles, label) in enumerate(rules):
        for nd in needles:
            out.append((i, nd, label))
    return out
