"""Text functions for Korean legal questions and answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize

# Keywords of the question modes in order, subject patterns in order, section
# headings, formal endings (inside a clause, at the end).
QUESTION_MODES = {
    "requirement": ("요건", "성립", "조건", "갖추어야", "요소"),
    "definition": ("의미", "뜻", "정의", "일컫", "란 무엇", "무엇을 말", "말하나요"),
    "scope": ("범위", "어떤", "어느", "대상", "해당하는"),
}
SUBJECT_PATTERNS = (
    "^.+에서 일컫는 (.+?)란 무엇인가요$",
    "^(.+?)란 무엇인가요$",
    "^(.+?)는 무엇인가요$",
    "^(.+?)는 어떤 .+?를 말하나요$",
    "^(.+?)은 어떤 .+?인가요$",
    "^(.+?)는 어떤 .+?인가요$",
    "^(.+?)의 요건은 무엇인가요$",
    "^(.+?)의 범위는 무엇인가요$",
)
SECTION_HEADINGS = ("질의요지", "질의배경", "회답", "이유")
FORMAL_ENDINGS = (
    ("초과하지 아니할 것", "초과하지 않아야 하고", "초과하지 않아야 합니다"),
    ("하지 아니할 것", "하지 않아야 하고", "하지 않아야 합니다"),
    ("아니할 것", "않아야 하고", "않아야 합니다"),
    ("보유할 예정일 것", "보유할 예정이어야 하고", "보유할 예정이어야 합니다"),
    ("일 것", "이어야 하고", "이어야 합니다"),
    ("할 것", "해야 하고", "해야 합니다"),
)


def question_mode(c: Column | str) -> Column:
    """requirement, definition or scope by the first list with a keyword; else criteria."""
    text = normalize(c)
    out: Column = F.lit("criteria")
    for mode, keys in reversed(QUESTION_MODES.items()):
        out = F.when(text.rlike("|".join(keys)), mode).otherwise(out)
    return out


def question_subject(c: Column | str) -> Column:
    """Group one of the first pattern that fits, else the question without question marks."""
    q = F.regexp_replace(normalize(c), r"\?+$", "")
    found = [F.when(q.rlike(p), normalize(F.regexp_extract(q, p, 1))) for p in SUBJECT_PATTERNS]
    return F.coalesce(*found, q)


def structured_sections(c: Column | str) -> Column:
    """An array of (header, content) at ``heading:`` places; the whole text under 본문 without any.
    Empty sections are left out."""
    text = normalize(c)
    heading = "(" + "|".join(SECTION_HEADINGS) + r")\s*:"
    heads = F.regexp_extract_all(text, F.lit(heading), F.lit(1))
    bodies = F.slice(F.split(text, heading), 2, 1_000_000)
    pairs = F.filter(F.zip_with(heads, bodies, lambda h, b: F.struct(h.alias("header"), F.trim(b).alias("content"))), lambda s: s["content"] != "")
    whole = F.array(F.struct(F.lit("본문").alias("header"), text.alias("content")))
    return F.when(F.size(pairs) > 0, pairs).otherwise(whole)


def section_text(c: Column | str, header: str) -> Column:
    """The first section of that heading, empty without one."""
    found = F.filter(structured_sections(c), lambda s: s["header"] == header)
    return F.coalesce(F.try_element_at(found, F.lit(1))["content"], F.lit(""))


def formal_clause(c: Column | str, final: bool) -> Column:
    """A statutory item as a clause: the longest known ending is turned into a formal one; a final
    clause without a known ending closes formally."""
    text = F.regexp_replace(normalize(c), r"\.+$", "")
    rest = F.when(text.endswith("합니다"), text).otherwise(F.concat(text, F.lit("입니다"))) if final else text
    out = rest
    for ending, inner, closing in reversed(FORMAL_ENDINGS):
        stem = F.substring(text, F.lit(1), F.length(text) - len(ending))
        out = F.when(text.endswith(ending), F.concat(stem, F.lit(closing if final else inner))).otherwise(out)
    return out


# Statute headings, tails and endings of questions with what takes their place, in the
# order in which they are tried; phrases that make a question two; openings by document type.
STATUTE_HEAD = r"제[0-9]+조(?:의[0-9]+)?\([^)]+\)"
STEM_TAILS = ("와 관련된 핵심 판단 기준은 무엇인가요$", "의 핵심 판단 기준은 무엇인가요$", "의 이유는 무엇인가요$", "무엇인가요$", "무엇입니까$")
META_TAILS = (r"와 관련된 핵심 판단 기준은 무엇인가요\??$", r"와 관련된 법원의 판단 기준은 무엇인가요\??$", r"의 판단 기준은 무엇인가요\??$")
IMPERATIVES = (
    (r"어떻게 진행되나요\??$", "절차를 설명하시오."),
    (r"어떻게 되나요\??$", "설명하시오."),
    (r"무엇인가요\??$", "설명하시오."),
    (r"무엇입니까\??$", "설명하시오."),
    (r"무엇인가$", "설명하시오."),
    (r"왜 .+ 판단하였습니까\??$", "그 판단 이유를 설명하시오."),
    (r"왜 .+ 판단되었나요\??$", "그 판단 이유를 설명하시오."),
    (r"이유는 무엇인가요\??$", "이유를 설명하시오."),
    (r"어떤 요소를 고려해야 하나요\??$", "고려해야 하는 요소를 설명하시오."),
    (r"해당하나요\??$", "해당 여부를 설명하시오."),
)
REQUESTS = ("설명하시오.", "서술하시오.", "밝히시오.")
SPLIT_TAILS = ("와 관련된 핵심 판단 기준은 무엇인가요", "와 관련된 법원의 판단 기준은 무엇인가요", "의 판단 기준은 무엇인가요")
DOUBLE_PREDICATES = ((("판단 근거", "판단의 근거", "근거"), ("적용 범위", "범위")), (("요건",), ("효과",)), (("우선순위", "우선 순위"), ("절차",)), (("기준",), ("정함 방식", "정하는 방식")))
OPENINGS = {"법령_QA": "다음 법령 상황에 관하여, ", "해석례_QA": "다음 해석례 상황에 관하여, ", "결정례_QA": "다음 결정례 상황에 관하여, "}
LAST_OPENING = "다음 판결문 상황에 관하여, "
MODE_ENDINGS = {
    "standard_reframe": "관련 판단 기준을 설명하시오.",
    "issue_application": "해당 사안에서의 법적 판단과 이유를 설명하시오.",
    "requirement_check": "성립 요건 또는 충족 요건을 서술하시오.",
    "scope_boundary": "적용 범위 또는 해당 여부를 설명하시오.",
}
LAST_ENDING = "관련 쟁점을 설명하시오."
CHOICE_REQUESTS = ("고르시오.", "고르세요.", "고르십시오.")
CITATION = r"^((?:구\s*)?[「」A-Za-z가-힣·ㆍ\s]+제[0-9]+조(?:제[0-9]+항)?(?:제[0-9]+호)?)(?:에 따르면|에 따라),?\s*"


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def without_statute_head(c: Column | str) -> Column:
    return F.regexp_replace(normalize(c), rf"^{STATUTE_HEAD}\s*", "")


def statute_head_only(c: Column | str) -> Column:
    return normalize(c).rlike(f"^{STATUTE_HEAD}$")


def compressed_stem(c: Column | str) -> Column:
    """A question without its closing words."""
    out = F.regexp_replace(normalize(c), r"\?+$", "")
    for tail in STEM_TAILS:
        out = F.regexp_replace(out, tail, "")
    return F.regexp_replace(out, "[ ,]+$", "")


def without_meta_tail(c: Column | str) -> Column:
    out = normalize(c)
    for tail in META_TAILS:
        out = F.regexp_replace(out, tail, "")
    return F.regexp_replace(normalize(out), "[ ,]+$", "")


def imperative(c: Column | str) -> Column:
    """A question as a request: the first ending that fits is replaced, else a request is added."""
    q = without_meta_tail(c)
    out = F.concat(F.regexp_replace(q, r"\.+$", ""), F.lit("를 설명하시오."))
    asked = [q.endswith(r) for r in REQUESTS]
    out = F.when(asked[0] | asked[1] | asked[2], q).otherwise(out)
    out = F.when(q.endswith("?"), F.concat(F.regexp_replace(q, r"\?$", ""), F.lit("를 설명하시오."))).otherwise(out)
    out = F.when(F.contains(q, F.lit("아니면")), F.concat(F.regexp_replace(q, r"\?+$", ""), F.lit("를 어떻게 판단해야 하는지 설명하시오."))).otherwise(out)
    for pattern, to in reversed(IMPERATIVES):
        out = F.when(q.rlike(pattern), F.regexp_replace(q, pattern, to)).otherwise(out)
    return out


def query_signals(c: Column | str) -> Column:
    """Signs that a question asks several things, joined by ``|``."""
    q = normalize(c)
    has = lambda w: F.contains(q, F.lit(w))
    found = F.concat_ws(
        "|",
        F.when(has(SPLIT_TAILS[0]), "reason_plus_standard"),
        F.when(has(SPLIT_TAILS[1]), "reason_plus_court_standard"),
        F.when(has(SPLIT_TAILS[2]), "embedded_question_plus_standard"),
        F.when(has("아니면"), "explicit_alternative"),
        F.when(has("여부") & has("법적 입장"), "issue_plus_position"),
    )
    return F.when(found == "", "split_candidate_manual_lock").otherwise(found)


def split_failed(c: Column | str) -> Column:
    q = normalize(c)
    return (F.regexp_count(q, F.lit(r"\?")) >= 2) | F.contains(q, F.lit("아니면")) | _has(q, SPLIT_TAILS)


def double_predicate(c: Column | str) -> Column:
    """Whether a stem asks for two things or asks twice."""
    q = normalize(c)
    has = lambda w: F.contains(q, F.lit(w))
    out = (has("가장 옳은 것은") & (has("고르시오") | has("옳은 설명"))) | (has("무엇인가") & has("고르시오"))
    for left, right in DOUBLE_PREDICATES:
        out = out | (_has(q, left) & _has(q, right))
    return out


def fallback_problem(doc_type: Column, question: Column, mode: Column) -> Column:
    """A problem without a model: opening by document type, the stem, ending by mode."""
    opening, ending = F.lit(LAST_OPENING), F.lit(LAST_ENDING)
    for kind, text in OPENINGS.items():
        opening = F.when(doc_type == kind, text).otherwise(opening)
    for kind, text in MODE_ENDINGS.items():
        ending = F.when(mode == kind, text).otherwise(ending)
    return normalize(F.concat(opening, compressed_stem(question), F.lit(" "), ending))


def requested(c: Column | str) -> Column:
    """A problem that ends as a request."""
    q = normalize(c)
    asked = q.endswith(REQUESTS[0]) | q.endswith(REQUESTS[1]) | q.endswith(REQUESTS[2])
    return F.when(asked, q).otherwise(F.concat(F.regexp_replace(q, "[.?]+$", ""), F.lit(" 설명하시오.")))


def choice_stem(c: Column | str) -> Column:
    """A stem that ends by asking for a choice."""
    q = normalize(c)
    asked = q.endswith(CHOICE_REQUESTS[0]) | q.endswith(CHOICE_REQUESTS[1]) | q.endswith(CHOICE_REQUESTS[2])
    return F.when(asked, c).otherwise(F.concat(F.regexp_replace(q, "[.?]+$", ""), F.lit(" 옳은 설명을 고르시오.")))


def reframed(doc_type: Column, law_mode: Column, title: Column, question: Column) -> Column:
    """A question about a document's title: what it asks by document type and law mode."""
    asked = F.when(law_mode == "definition", "의 의미는").when(law_mode == "requirement", "의 요건은").when(law_mode == "scope", "의 범위는").otherwise("의 판단 기준은")
    plain = F.regexp_replace(normalize(question), r"\?+$", "")
    return (
        F.when(doc_type == "법령_QA", F.concat(title, F.lit(" 기준으로, "), question_subject(question), asked, F.lit(" 무엇인가요?")))
        .when(doc_type == "해석례_QA", F.concat(title, F.lit(" 해석례 기준으로, "), plain, F.lit("의 판단 기준은 무엇인가요?")))
        .when(doc_type == "결정례_QA", F.concat(title, F.lit(" 결정례에서 "), plain, F.lit("와 관련된 핵심 판단 기준은 무엇인가요?")))
        .otherwise(F.concat(title, F.lit(" 판결에서 "), plain, F.lit("와 관련된 법원의 판단 기준은 무엇인가요?")))
    )


def definition_body(c: Column | str) -> Column:
    """What a statute says after its heading, notes of change and the defined name."""
    text = F.regexp_replace(without_statute_head(c), r"\s*<개정[^>]+>", "")
    return normalize(F.when(F.contains(text, F.lit("란 ")), F.regexp_extract(text, "(?s)란 (.*)$", 1)).otherwise(text))


def law_short_answer(mode: Column, subject: Column, body: Column, items: Column, fallback: Column) -> Column:
    """Short answer of a law row: its definition, closed formally and opened by its subject; its
    scope from listed items; else the fallback."""
    closed = F.regexp_replace(body, r"말한다\.?$", "말합니다.")
    defined = F.when((subject != "") & ~closed.startswith(subject), F.concat(subject, F.lit("란 "), closed)).otherwise(closed)
    scope = F.concat(subject, F.lit("의 범위는 "), F.array_join(items, " 또는 "), F.lit("입니다."))
    plain = F.regexp_replace(fallback, r"\.([0-9]+\.)", ". $1")
    return F.when((mode == "definition") & (body != ""), defined).when((mode == "scope") & (F.size(items) > 0), scope).otherwise(plain)


def law_reference(anchor: Column | str, suffix: Column | str) -> Column:
    """(law_name, article) of a link text: quoted names first, else what stands before an article."""
    a, tail = normalize(anchor), normalize(suffix)
    quoted = r"^[「『]([^」』]*)[」』](.*)$"
    name = F.when(a.rlike(quoted), F.regexp_extract(a, quoted, 1)).when(F.contains(a, F.lit(" 제")), F.trim(F.regexp_extract(a, "^(.*?) 제", 1))).otherwise(a)
    own = F.when(a.rlike(quoted), F.trim(F.regexp_extract(a, quoted, 2))).when(F.contains(a, F.lit(" 제")), F.concat(F.lit("제"), F.trim(F.regexp_extract(a, "^.*? 제(.*)$", 1)))).otherwise("")
    return F.struct(name.alias("law_name"), F.trim(F.concat(own, F.lit(" "), tail)).alias("article"))


def inline_pair(c: Column | str) -> Column:
    """(question, answer) of a body that holds ``Q. ... A. ...``, empty texts if either lacks."""
    pattern = r"(?s)(?:^|\s)Q\s*[.．:：]\s*(.+?)\s+A\s*[.．:：]\s*(.+)"
    text = F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))
    question, answer = (normalize(F.regexp_extract(text, pattern, i)) for i in (1, 2))
    both = (question != "") & (answer != "")
    return F.struct(F.when(both, question).otherwise("").alias("question"), F.when(both, answer).otherwise("").alias("answer"))


def phone(c: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")), r"☏\s*([0-9-]+)", 1)


def relaxed_citation(sentences: Column, evidence: Column) -> Column:
    """Sentences as one text; the last one loses a citation that the evidence doesn't have."""
    last = F.try_element_at(sentences, F.lit(-1))
    cited = normalize(F.regexp_extract(last, CITATION, 1))
    unknown = (cited != "") & ~F.contains(normalize(evidence), cited)
    own = F.when(unknown, F.trim(F.regexp_replace(last, CITATION, ""))).otherwise(last)
    body = F.slice(sentences, F.lit(1), F.greatest(F.size(sentences) - 1, F.lit(0)))
    return F.array_join(F.filter(F.concat(body, F.array(own)), lambda s: F.coalesce(s, F.lit("")) != ""), " ")


def law_items(sections: Column, texts: Column) -> Column:
    """The texts of items and sub-items, and of numbered sentences, without their numbers."""
    rows = F.zip_with(sections, texts, lambda s, t: F.struct(s.alias("s"), normalize(t).alias("t")))
    kept = F.filter(rows, lambda r: r["s"].isin("호", "목") | r["t"].rlike(r"^[0-9]+\."))
    return F.filter(F.transform(kept, lambda r: F.regexp_replace(r["t"], r"^[0-9]+\.\s*", "")), lambda t: t != "")


# Phrases of a seed question and what its stem core has in their place, in this order.
STEM_CORE_FOLDS = (
    (r"(.+?)은 어떻게 정해지나요의 판단 기준은 무엇인가요\??$", "$1 정함 기준"),
    (r"(.+?)은 어떻게 정해지나요\??$", "$1 정함 기준"),
    (r"(.+?)어떤 조건을 갖추어야 하나요의 요건은 무엇인가요\??$", "$1갖추어야 할 요건"),
    (r"(.+?)어떤 조건을 갖추어야 하나요\??$", "$1갖추어야 할 요건"),
    (r"\s*기준으로,\s*", "에 따른 "),
    (r"\s*기준으로\s*", "에 따른 "),
    (r"와 관련된 핵심 판단 기준은 무엇인가요\??$", ""),
    (r"의 판단 기준은 무엇인가요\??$", " 판단 기준"),
    (r"의 요건은 무엇인가요\??$", " 요건"),
    (r"의 이유는 무엇인가요\??$", " 이유"),
    (r"신고해야 하는 서류의 판단 기준은 무엇인가요\??$", "신고 첨부서류"),
    (r"무엇인가요\??$", ""),
    (r"무엇입니까\??$", ""),
)


def behind(phrase: str, instead: str) -> tuple[str, str]:
    """A fold of what ends a line, ``(.+?)phrase$`` to ``$1instead``, as one that looks back a single character: the
    first form starts anew at every character of a text without the phrase."""
    kept = phrase.startswith("(.+?)") and phrase.endswith("$") and instead.startswith("$1")
    return ("(?<=.)" + phrase[5:], instead[2:]) if kept else (phrase, instead)


def stem_core(c: Column | str) -> Column:
    """A seed question as the core of a choice stem: one predicate, no question."""
    out = normalize(c)
    for phrase, instead in STEM_CORE_FOLDS:
        out = F.regexp_replace(out, *behind(phrase, instead))
    return F.regexp_replace(out, "[ ,.?]+$", "")
