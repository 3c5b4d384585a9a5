"""The text problems' queries over the small tables."""

from dialoom.llm import queries


def test_p1(spark, data):
    rows = queries.p1_found(spark, data).collect()
    ids = [r["prompt_response_id"] for r in rows]
    assert len(ids) == len(set(ids)) and {r["defect"] for r in rows} <= {"empty", "truncated", "refusal", "copies_prompt", "other_language"}


def test_p6_p7(spark, data):
    n = {r["doc_id"]: len(r["ids"]) for r in queries.p6_ids(spark, data).collect()}
    packed = queries.p7_containers(spark, data).collect()
    for profile in {r["profile_id"] for r in packed}:
        total = {}
        for r in packed:
            if r["profile_id"] == profile:
                total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
        assert total == {k: v for k, v in n.items() if v}


def test_p8(spark, data):
    ids = [r[0] for r in queries.p8_found(spark, data).collect()]
    assert len(ids) == len(set(ids)) and None not in ids
