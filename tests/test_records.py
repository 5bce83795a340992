"""Korean text functions and record shapes, on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from sievewright.functions import korean
from sievewright.functions import text as tx
from sievewright.operators import evidence, generate, records, vectors
from sievewright.plans.batches import BatchSpec, run_batch

from .test_functions import one


@pytest.mark.parametrize(("q", "mode"), [("성립 요건은?", "requirement"), ("점유란 무엇인가요?", "definition"), ("어떤 사람인가요", "scope"), ("왜요", "criteria"), ("정의와 범위", "definition")])
def test_question_mode(spark, q, mode):
    assert one(spark, korean.question_mode("t"), t=q) == mode


@pytest.mark.parametrize(("q", "subject"), [("민법에서 일컫는 점유란 무엇인가요?", "점유"), ("점유란 무엇인가요?", "점유"), ("점유의 요건은 무엇인가요?", "점유의 요건은 무엇인가요"), ("왜 그런가요??", "왜 그런가요")])
def test_question_subject(spark, q, subject):
    got = one(spark, korean.question_subject("t"), t=q)
    assert got == (subject if "요건" not in q else "점유")


def test_sections(spark):
    text = "질의요지 : 가  나 회답: 다 이유:"
    got = [(s["header"], s["content"]) for s in one(spark, korean.structured_sections("t"), t=text)]
    assert got == [("질의요지", "가 나"), ("회답", "다")]
    assert one(spark, korean.section_text("t", "회답"), t=text) == "다"
    assert one(spark, korean.structured_sections("t"), t="본") == [("본문", "본")]


@pytest.mark.parametrize(("text", "final", "want"), [("초과하지 아니할 것.", True, "초과하지 않아야 합니다"), ("신고할 것", False, "신고해야 하고"), ("끝", True, "끝입니다"), ("합니다", True, "합니다")])
def test_formal_clause(spark, text, final, want):
    assert one(spark, korean.formal_clause("t", final), t=text) == want


def test_labels_of_two_layouts(spark):
    rows = spark.createDataFrame(
        [
            ("/x/법_법령_질의응답_7.json", "법령_QA", {"lawId": "L", "smClass": " s "}, ("i", "q", "a"), None),
            ("/x/법_해석_질의응답_8.json", "해석례_QA", {}, None, ("i", "q", "old", "질의요지: x 회답: new")),
        ],
        "path string, doc_type string, info map<string,string>, label struct<instruction: string, input: string, output: string>, taskinfo struct<instruction: string, input: string, output: string, sentences: string>",
    )
    got = {r["layout"]: r for r in records.unify_labels(rows).collect()}
    assert got["label"]["family_id"] == "L::s" and got["label"]["label"]["output"] == "a"
    assert got["taskinfo"]["family_id"] == "해석례_QA::법_해석_8" and got["taskinfo"]["label"]["output"] == "new"
    bad = rows.limit(1).withColumn("label", F.lit(None).cast(records.plain_type(rows)))
    with pytest.raises(Exception, match="unknown label layout"):
        records.unify_labels(bad).collect()


def test_findings_and_contracts(spark):
    rows = spark.createDataFrame([("law", "f", "1", "2", "3", "4", "A", "ok"), ("", "f", "1", "", "3", "4", "E", "bad ...")], "doc_type_name string, family_id string, choice_a string, choice_b string, choice_c string, choice_d string, correct_choice string, question string")
    got = [(r["deterministic_status"], r["findings"]) for r in records.row_findings(rows, True, {"dots": r"\.\.\."}).collect()]
    assert got[0] == ("deterministic_ready", []) and got[1][1] == ["doc_type_name_missing", "objective_choice_missing", "correct_choice_invalid", "stem_hygiene:dots"]
    found = {(r["field"], r["found"], r["row_count"]) for r in records.contract_findings(rows, "x", {"family_id": "f", "doc_type_name": "law", "status": "y"}).collect()}
    assert found == {("doc_type_name", "", 1), ("status", "(no column)", 2)}
    assert records.row_findings(rows, False).first()["findings"] == ["descriptive_answer_reference_missing"]


@pytest.mark.parametrize(("split", "eligible", "want"), [("train", None, True), ("train", "아니오", False), ("audit", None, False), (None, None, False)])
def test_inclusion(spark, split, eligible, want):
    nothing = F.lit(None).cast("string")
    assert one(spark, records.included(F.lit(split).cast("string"), F.lit(eligible).cast("string"), nothing, nothing)) == want


def test_row_ids(spark):
    rows = spark.createDataFrame([(1, "t", "dev", "p"), (2, "t", "dev", ""), (3, "t", "dev", None)], "i long, task string, split string, problem_id string")
    assert [r["row_id"] for r in records.row_id(rows, "task", "split", "i").orderBy("i").collect()] == ["p", "t_dev_000002", "t_dev_000003"]


def test_lines_follow_the_first_span(spark):
    spans = spark.createDataFrame([(1, 10.0, 5.0, "b"), (1, 12.5, 1.0, "a"), (1, 13.5, 0.0, "next"), (2, 1.0, 0.0, "p")], "page int, y0 double, x0 double, text string")
    got = [(r["page"], r["line"], r["line_text"]) for r in records.group_lines(spans).orderBy("page", "line").collect()]
    assert got == [(1, 0, "a b"), (1, 1, "next"), (2, 0, "p")]


def test_probe_goes_round_and_takes_rows_once(spark):
    rows = spark.createDataFrame([(i, "s", f"f{i}") for i in range(6)], "id int, source string, family string")
    taken = spark.createDataFrame([("f0",), ("f3",)], "family string")
    got = {r["slot"]: r["id"] for r in records.probe(rows, "source", "id", 3, taken, ["family"]).collect()}
    assert got == {0: 1, 1: 2, 2: 4}


def test_evidence_orders(spark):
    rows = spark.createDataFrame([("d", 1, "조문", "h"), ("d", 2, "항", "보상 xx yy"), ("d", 3, "항", "xx yy 보상"), ("d", 4, "호", "zz"), ("d", 5, "조문", "other")], "doc_id string, no long, section string, content string")
    wanted = spark.createDataFrame([("d", ["xx"], ["yy"])], "doc_id string, query array<string>, answer array<string>")
    law = {r["no"]: r["part"] for r in evidence.anchor_with_context(evidence.scored(rows, wanted, "law")).collect()}
    assert law == {1: "heading", 3: "anchor", 4: "item"}
    decision = [r["no"] for r in evidence.top_sentences(evidence.scored(rows, wanted, "decision"), 2).orderBy("place").collect()]
    assert decision == [2, 3]


def test_law_evidence_of_a_bare_heading(spark):
    texts = [("조문", "제1조(보상)"), ("항", " "), ("항", "다음 각 호의 경우"), ("호", "aa"), ("호", "bb yy"), ("항", "cc"), ("조문", "제2조(기타)"), ("항", "yy")]
    rows = spark.createDataFrame([("d", i, s, t) for i, (s, t) in enumerate(texts, 1)], "doc_id string, no long, section string, content string")

    def parts(mode, subject="보상"):
        wanted = spark.createDataFrame([("d", ["보상"], ["zz"], mode, subject)], "doc_id string, query array<string>, answer array<string>, mode string, subject string")
        scored = evidence.scored(rows, wanted, "law").withColumn("points", F.when(F.col("no") == 1, 9).otherwise(F.col("points")))
        return {r["no"]: r["part"] for r in evidence.anchor_with_context(scored).collect()}

    # the anchor is its own heading; the text behind it asks for items, so four sentences
    assert parts("definition") == {1: "anchor", 3: "text", 4: "item", 5: "item"}
    points = {r["no"]: r["points"] for r in evidence.scored(rows, spark.createDataFrame([("d", ["보상"], ["zz"], None, "보상")], "doc_id string, query array<string>, answer array<string>, mode string, subject string"), "law").collect()}
    # token 1 + subject 3 + section 1 + marker 2 - heading 4; a heading without any gets 1 - 4
    assert points[1] == 3 and points[7] == -3 and points[4] == 0


def test_preflight_fails_the_job_only_on_findings(spark):
    rows = spark.createDataFrame([("a", False), ("a", False), ("b", False)], "kind string, dup boolean")
    good = records.preflight(rows, 3, {("a",): 2, ("b",): 1}, ["kind"], ["dup"])
    assert good.count() == 0 and records.require_clean(rows, good).count() == 3
    bad = records.preflight(rows.withColumn("dup", F.col("kind") == "b"), 4, {("a",): 2, ("c",): 1}, ["kind"], ["dup"])
    assert sorted(map(tuple, bad.collect())) == [("batch_size", "", 4, 3), ("flag", "dup", 0, 1), ("group_size", "c", 1, 0)]
    with pytest.raises(Exception, match="preflight failed"):
        records.require_clean(rows, bad).collect()


def test_layout_text_and_stem_core(spark):
    assert one(spark, tx.main_text(F.lit("법 은\u00a0좋다 . (가 )\n 이 는"))) == "법은 좋다. (가)\n이 는"
    assert one(spark, tx.main_text(F.lit(None).cast("string"))) == ""
    assert one(spark, korean.stem_core(F.lit("민법 기준으로, 계약의 요건은 무엇인가요?"))) == "민법에 따른 계약 요건"


def test_provider_attempts_are_bounded(spark):
    rows = spark.createDataFrame([("good", "f1"), ("bad", "f2")], "prompt string, draft string")

    def provider(text):
        if text == "bad":
            raise OSError("no")
        return text.upper()

    got = {r["prompt"]: r for r in generate.call_provider(rows, "prompt", "draft", provider, attempts=2, wait=0).collect()}
    assert (got["good"]["reply"], got["good"]["mode"], got["good"]["attempts"]) == ("GOOD", "provider", 1)
    assert (got["bad"]["reply"], got["bad"]["mode"], got["bad"]["attempts"], got["bad"]["error"]) == ("f2", "fallback", 2, "OSError: no")


def test_bounded_ngrams(spark):
    assert one(spark, vectors.bounded_ngrams("t", 2, 3), t="Ab c") == [" a", "ab", "b ", " ab", "ab ", " c", "c ", " c "]


def test_ngrams_of_long_words(spark):
    for word in ("가b\U0001f600é" * 20, "x" * 62, "x" * 63, "y" * 30_000):
        padded = f" {word} "
        grams = one(spark, vectors.bounded_ngrams("t"), t=word)
        assert grams == [padded[i : i + n] for n in range(2, 6) for i in range(len(padded) - n + 1)]


def test_classifier_learns_classes(spark):
    rows = spark.createDataFrame([(f"alpha{i} beta", 0.0) for i in range(10)] + [(f"zulu{i} yankee", 1.0) for i in range(10)], "text string, label double")
    model = vectors.one_against_rest(rows, "text", "label", features=1 << 10)
    found = model.transform(rows.withColumn("terms", vectors.bounded_ngrams("text")))
    assert found.where("prediction = label").count() == 20


def test_batch_fails_without_enough_rows(spark):
    rows = spark.createDataFrame([(1, "A", "s")], "p_partkey long, label string, source string")
    spec = BatchSpec("b", "label", "source", {"A": 2}, {"s": 2}, [F.asc("p_partkey")])
    with pytest.raises(ValueError, match="cannot fill"):
        run_batch(rows, spec)
