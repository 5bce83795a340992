"""The validator application row by row."""

import json

from pyspark.sql import functions as F

from sievewright.operators import validator

BASE = {
    "choice_a": "가 나", "choice_b": "다", "choice_c": "라", "choice_d": "마", "correct_choice": "A", "error_tags": "", "final_status": "pass", "audit_required": "아니오", "audit_reason": "",
    "train_eligible": "예", "distractor_type_map": json.dumps({"A": "정답", "B": "범위", "D": "요건"}, ensure_ascii=False), "near_miss_notes": json.dumps({"B": "한 \"축\"", "C": "주체"}, ensure_ascii=False), "taken": True,
}
CASES = [
    {},  # target A
    {"audit_required": "예", "audit_reason": "old"},  # B
    {"error_tags": "오답약함"},  # C
    {"choice_c": "가나"},  # D
    {"correct_choice": "E"},  # A
    {"distractor_type_map": '{"B":"정답"}'},  # B
    {"final_status": "hard_fail", "error_tags": "오답약함|x"},  # C
    {"distractor_type_map": "", "near_miss_notes": "not json"},  # D
    {"taken": False, "final_status": "soft_fail"},
    {"error_tags": None, "choice_d": None, "correct_choice": None, "audit_reason": None},  # A
    {},  # B
]
FIELDS = ["seed_sample_id", *BASE]


def test_every_action_and_permutation(spark):
    rows = [tuple({"seed_sample_id": i, **BASE, **c}[f] for f in FIELDS) for i, c in enumerate(CASES)]
    schema = ", ".join(f"{f} {'long' if f == 'seed_sample_id' else 'boolean' if f == 'taken' else 'string'}" for f in FIELDS)
    got = validator.apply_validator(spark.createDataFrame(rows, schema).repartition(3), F.col("taken"), [F.col("seed_sample_id")])
    by = {r["seed_sample_id"]: r for r in got.collect()}
    actions = [by[i]["validator_action"] for i in range(len(CASES))]
    assert actions == ["accept", "audit", "regenerate", "hard_block", "hard_block", "hard_block", "hard_block", "accept", "", "hard_block", "accept"]
    assert [by[i]["validator_target_correct_choice"] for i in range(len(CASES))] == [*"ABCDABCD", "", "A", "B"]
    a, b = by[0], by[1]
    assert (a["choice_a"], a["correct_choice"], a["validator_export_disposition"], a["train_eligible"]) == ("가 나", "A", "export_ready", "예")
    assert [b[f"choice_{x}"] for x in "abcd"] == ["다", "가 나", "라", "마"] and b["correct_choice"] == "B"
    assert b["distractor_type_map"] == '{"A": "범위", "B": "정답", "D": "요건"}'
    assert b["near_miss_notes"] == '{"A": "한 \\"축\\"", "C": "주체"}'
    assert (b["audit_reason"], b["audit_required"], b["final_status"], b["upstream_audit_required"]) == ("old|validator_audit", "예", "pass", "예")
    assert (by[2]["error_tags"], by[2]["final_status"], by[2]["correct_choice"]) == ("오답약함|validator_regenerate", "soft_fail", "A")
    assert by[3]["validator_reasons"] == "duplicate_or_equivalent_choice_text|correct_answer_not_unique_after_normalization|correct_choice_recalc_mismatch"
    assert (by[4]["validator_status"], by[4]["validator_shuffle_recalc_ok"], by[4]["validator_metadata_remap_ok"]) == ("correct_choice_recalc_block", "아니오", "대상아님")
    assert (by[5]["validator_status"], by[5]["final_status"], by[5]["validator_metadata_remap_reasons"]) == ("metadata_remap_block", "hard_fail", "distractor_type_map_correct_choice_mismatch")
    assert by[6]["validator_reasons"] == "weak_distractor_signal|upstream_hard_fail"
    assert by[7]["distractor_type_map"] == "" and by[7]["near_miss_notes"] == "not json" and by[7]["choice_d"] == "가 나"
    assert by[8]["report"] is None and by[8]["final_status"] == "soft_fail" and by[8]["validator_reasons"] == ""
    assert validator.report_rows(got).count() == len(CASES) - 1
    one = validator.package_summary(got, dict.fromkeys("ABCD", 1), usable=3, hard=5, soft=1, audits=1).first()
    assert (one["accept_count"], one["export_A"], one["export_B"], one["export_D"], one["success_passed"]) == (3, 1, 2, 1, False)
    assert validator.package_summary(got.where("false"), dict.fromkeys("ABCD", 0), 0, 0, 0, 0).first()["selected_count"] == 0
