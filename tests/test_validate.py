import pytest
from helpers import RECORD, good, record, write_lines

from tamis.operators import validate as V
from tamis.sources import readers


def codes(spark, tmp_path, rows):
    v = V.validate_lines(readers.jsonl(spark, write_lines(tmp_path / "x.jsonl", rows)))
    return {r["_line"]: [e["code"] for e in r["errors"]] for r in v.collect()}


@pytest.mark.parametrize("field", ["id", "messages", "category", "source", "language"])
def test_missing_field(spark, tmp_path, field):
    assert "missing_field" in codes(spark, tmp_path, [good(**{field: "__drop__"})])[1]


def test_each_defect(spark, tmp_path):
    rows = [
        good(), "{bad", "[1]", good(category="x"), good(language="xx"), good(messages=[]),
        good(messages=[{"role": "bot", "content": "a"}, {"role": "assistant", "content": "b"}]),
        good(messages=[{"role": "assistant", "content": "a"}, {"role": "user", "content": "b"}]),
        good(messages=[{"role": "user", "content": "  \t"}, {"role": "assistant", "content": "b"}]),
        good(id=" "), good(script="runic", more=1), "", good(id=5, quality={"flagged": 1, "odd": True}), good(id="a b"), good(script=None), good(source=""),
        good(messages=[{"role": "user"}]), good(messages=[{"role": "system", "content": "s"}]), good(code_switching="yes"), good(language="ar", script="latin"),
        good(messages=[{"role": "user", "content": 3}, {"role": "assistant", "content": "b"}]),
    ]
    c = codes(spark, tmp_path, rows)
    assert c[1] == [] and 12 not in c
    assert c[2] == ["invalid_json"] and c[3] == ["invalid_type"]
    assert c[4] == ["invalid_category"] and c[5] == ["invalid_language"] and c[6] == ["empty_messages"]
    assert c[7] == ["invalid_role", "invalid_ordering"] and c[8] == ["invalid_ordering", "invalid_ordering"]
    assert c[9] == ["empty_content"] and c[10] == ["empty_id"] and c[11] == ["invalid_script", "unknown_field"]
    assert c[13] == ["invalid_type", "invalid_quality_flag", "invalid_quality_flag"] and c[14] == ["invalid_id"]
    assert c[15] == ["invalid_script"] and c[16] == ["empty_source"] and c[17] == ["too_few_turns", "missing_field"]
    assert c[18] == ["too_few_turns", "empty_messages"] and c[19] == ["invalid_type"] and c[20] == ["language_script_mismatch"]
    assert c[21] == ["invalid_type"]


def test_duplicates_drop_all_from_valid(spark):
    df = spark.createDataFrame([record(1, id="x"), record(2, id="x"), record(3), record(4, id=None)], RECORD)
    dup = V.duplicate_ids(df).collect()
    assert [(r["line"], r["message"]) for r in dup] == [(2, "first on line 1")]
    v = V.validate_table(df, "line_no")
    assert [r["line_no"] for r in V.valid_rows(df, v, "line_no").collect()] == [3]
    rep = V.report(v, V.duplicate_ids(df)).first()
    assert (rep["total_records"], rep["valid_records"], rep["ok"]) == (4, 2, False)


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        readers.jsonl(spark, "/nowhere/x.jsonl")
