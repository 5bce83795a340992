"""Question stems of the second patch: endings folded, one issue a stem; and their audited cleaning."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .korean import stem_core
from .text import normalize, rewrite, rewrite_audited

# Endings that go, in this order; the ending of each mode; tails and what they become;
# phrases of two issues, words of issues; folds of a law stem; rules of the release's cleaning.
NOISE_ENDINGS = (
    r"\s*옳은 설명을 고르시오\.?$",
    r"\s*가장 적절한 설명을 고르시오\.?$",
    r"\s*올바른 적용 범위를 고르시오\.?$",
    r"\s*옳은 것은 무엇인가\??$",
    r"\s*가장 옳은 것은 무엇인가\??$",
    r"\s*가장 적절한 것은 무엇인가\??$",
    r"\s*가장 적절한 것은$",
    r"\s*가장 정확하게 고르시오\.?$",
    r"\s*가장 정확하게 선택하시오\.?$",
    r"\s*판단하시오\.?$",
    r"\s*무엇인가요\??$",
    r"\s*무엇입니까\??$",
)
MODE_ENDINGS = {"single_best_rule": "옳은 설명을 고르시오.", "single_best_application": "가장 적절한 설명을 고르시오.", "single_best_scope": "올바른 적용 범위를 고르시오."}
CHOICE_TAILS = (
    ("핵심을$", "핵심에 관하여"),
    ("판단 기준$", "판단 기준에 관하여"),
    ("정함 기준$", "정함 기준에 관하여"),
    ("신고 첨부서류$", "신고 첨부서류에 관하여"),
    ("요건$", "요건에 관하여"),
    ("이유$", "이유에 관하여"),
)
TWO_ISSUES = ("요건과 방식", "기준과 정함 방식", "구비요건과 지정 경로", "가치와 그 산정기준의 정함 방식", "요건과 절차", "기준과 절차")
ISSUE_WORDS = ("요건", "기준", "방식", "절차", "경로", "효과")
LAW_FOLDS = (
    ("요건과 방식", "요건"),
    ("기준과 정함 방식", "기준"),
    ("구비요건과 지정 경로", "지정 요건"),
    ("지정 요건과 방식", "지정 요건"),
    ("가치와 그 산정기준의 정함 방식", "보험가액의 정함 기준"),
    (r"을 중심으로 판단하시오\.?", ""),
    (r"조문은 .*?함께 두고 있다", ""),
    (r"판단의 초점은 .*", ""),
)
RELEASE_RULES = (
    ("가장 타당한 것은 무엇인가 옳은 설명을 고르시오", "가장 타당한 설명을 고르시오"),
    ("기준은 무엇인가 옳은 설명을 고르시오", "기준에 관한 옳은 설명을 고르시오"),
    ("무엇인가 옳은 설명을 고르시오", "무엇인지에 관한 옳은 설명을 고르시오"),
    ("무엇인가 를", "무엇인지를"),
    ("기간은 얼마인가요의 범위", "기간의 범위"),
    (r"가장 옳은 것은\s*(.*?)\s*고르시오", "$1에 관하여 가장 옳은 설명을 고르시오"),
)
CLOSED = (".", "?", "다", "오")


def once(c: Column, then: Callable[[Column], Column]) -> Column:
    """What ``then`` makes of a column that is computed once a row, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(c), then), 1)


def choice_tail(c: Column) -> Column:
    """The first tail that a stem ends with, turned into what a choice can follow."""
    return reduce(lambda out, rule: F.when(c.rlike(rule[0]), F.regexp_replace(c, rule[0], rule[1])).otherwise(out), reversed(CHOICE_TAILS), c)


def with_mode_ending(c: Column | str, mode: Column, passes: int = 1) -> Column:
    """A stem without doubled endings, closed by the ending of its mode. Endings go in order, one
    pass over them; with more passes until none is left behind another."""
    step = lambda s, _: rewrite(s, [(p, "") for p in NOISE_ENDINGS])
    bare = F.aggregate(F.sequence(F.lit(1), F.lit(passes)), normalize(c), step)
    ending = reduce(lambda out, m: F.when(mode == m, MODE_ENDINGS[m]).otherwise(out), MODE_ENDINGS, F.lit(None).cast("string"))
    return F.concat(once(normalize(F.regexp_replace(bare, "[ .?]+$", "")), choice_tail), F.lit(" "), ending)


def first_sentence(c: Column) -> Column:
    return F.trim(F.regexp_extract(normalize(c), r"(?s)^(.*?(?:[.?!](?=\s)|$))", 1))


def several_issues(c: Column | str) -> Column:
    """Whether a law stem asks for more than one thing."""

    def several(text: Column) -> Column:
        words = reduce(lambda n, w: n + F.contains(text, F.lit(w)).cast("int"), ISSUE_WORDS, F.lit(0))
        joined = F.contains(text, F.lit("과")) | F.contains(text, F.lit("및"))
        return text.rlike("|".join(TWO_ISSUES)) | text.rlike(r"[.?!]\s") | ((words >= 3) & joined)

    return once(normalize(c), several)


def tightened_law_stem(c: Column | str, seed: Column | str, mode: Column) -> Column:
    """The first sentence with paired issues folded into one; if several are left, the seed's core."""
    folded = rewrite(first_sentence(c if isinstance(c, Column) else F.col(c)), list(LAW_FOLDS))
    core = once(folded, lambda f: F.when(several_issues(f), stem_core(seed)).otherwise(f))
    return with_mode_ending(core, mode)


def cleaned_stem(c: Column | str) -> Column:
    """A struct: the stem after the release's rules, closed by a mark; and the patterns that applied,
    none where the stem stays as it was."""
    text = F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))
    done = rewrite_audited(text, [(p, p, to) for p, to in RELEASE_RULES])
    body = normalize(done["text"])
    ended = reduce(lambda a, b: a | b, [body.endswith(e) for e in CLOSED])
    closed = F.when((body == "") | ended, body).otherwise(F.concat(body, F.lit(".")))
    none = F.array().cast("array<string>")
    return F.struct(closed.alias("text"), F.when(closed == text, none).otherwise(done["applied"]).alias("applied"))


def rule_counts(rows: DataFrame, applied: str) -> DataFrame:
    """How many rows each rule changed; rules that changed none have a row too."""
    seen = rows.select(F.explode(applied).alias("rule")).groupBy("rule").agg(F.count("*").alias("row_count"))
    rules = rows.sparkSession.createDataFrame([(i, p) for i, (p, _) in enumerate(RELEASE_RULES, 1)], "rule_no int, rule string")
    return rules.join(seen, "rule", "left").select("rule_no", "rule", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"))


def hygiene_manifest(rows: DataFrame, findings: str = "findings", prefix: str = "stem_hygiene:") -> DataFrame:
    """Rows with findings on their stem, and what has to happen before they are released."""
    own = F.filter(findings, lambda x: x.startswith(prefix))
    out = rows.withColumn("__own", own).where(F.size("__own") > 0)
    fixed = {"stem_hygiene_disposition": "repair_before_final_release", "api_required": "일부", "final_release_blocker_until_applied": "예"}
    return out.withColumn("stem_hygiene_findings", F.array_join("__own", "|")).withColumns({k: F.lit(v) for k, v in fixed.items()}).drop("__own", findings)
