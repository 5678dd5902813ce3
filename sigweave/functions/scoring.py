"""Confidence and heat, integers from 0 to 100."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base heat of a category; others have 40.
WEIGHTS = {"racing": 60, "new-models": 60, "culture": 50, "local-market": 45, "tech": 45, "industry": 35}
# Words that raise heat by 15 a line, 30 at most.
KEYWORDS = ["首发|首秀|全球首秀|debut", "停产|discontinued", "召回|recall", "破纪录|史上最高|创历史新高|record", "官宣|announce", "争议|controversy"]
# Words of a wide scope (30) and of a well-known rider (15).
INDUSTRY = "赛历|赛程|新规|禁令|规则变动|规则变更|席位|退出|转播权|转播|政策|行业协会|销量|市场份额|安全标准|安全隐患|存在隐患|风险|前景不明|推迟|延期|取消|calendar|regulation|championship rules|broadcast rights|postponed|canceled|cancelled"
RIDERS = "marquez|márquez|马奎兹|马奎斯"


def clamp(c: Column) -> Column:
    """Rounded half up, into 0 to 100."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.floor(c + 0.5))).cast("int")


def corroboration(sources: Column, each: int) -> Column:
    return F.least(sources - 1, F.lit(3)) * each


def confidence(authority: Column, primary: Column, sources: Column) -> Column:
    return clamp(F.coalesce(authority, F.lit(50)) * F.lit(0.6).cast("double") + F.when(primary, 20).otherwise(0) + corroboration(sources, 10))


def weight(category: Column) -> Column:
    return reduce(lambda acc, kv: F.when(category == kv[0], F.lit(kv[1])).otherwise(acc), WEIGHTS.items(), F.lit(40))


def folded(text: Column) -> Column:
    """In lower case. The two characters outside ASCII that lower case would turn into ASCII letters match none."""
    return F.lower(F.translate(text, "\u0130\u212a", "\ufffd\ufffd"))


def named(low: Column, words: str) -> Column:
    """Whether a folded text holds one of the words: a search of bytes for each, no pattern."""
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words.split("|")])


def keyword_hits(text: Column) -> Column:
    low = folded(text)
    return reduce(lambda a, b: a + b, [F.when(named(low, k), 1).otherwise(0) for k in KEYWORDS])


def freshness(hours: Column, known: Column) -> Column:
    return F.when(~known, 0).when(hours <= 24, 15).when(hours <= 72, 8).otherwise(0)


def scope(text: Column) -> Column:
    low = folded(text)
    return F.when(named(low, INDUSTRY), 30).when(named(low, RIDERS), 15).otherwise(0)


def heat(category: Column, sources: Column, text: Column, hours: Column, known: Column) -> Column:
    return clamp((weight(category) + corroboration(sources, 15) + F.least(keyword_hits(text) * 15, F.lit(30)) + freshness(hours, known) + scope(text)).cast("double"))
