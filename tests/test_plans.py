"""Plan checks: pruned scans, no Python in built-in paths, no payload shuffled."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL


def plan(df, mode="simple"):
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def scans(df):
    """(table, columns read) of the file scans."""
    p = plan(df, "formatted")
    found = re.findall(r"Location: \S+ \[file:[^\]]*/(\w+)\.parquet\].*?ReadSchema: struct<([^\n]*)>", p, re.S)
    return sorted({(t, tuple(sorted(c.split(":")[0] for c in cols.split(",")))) for t, cols in found})


def test_scan_reads_only_needed_columns(spark):
    assert scans(E.queries()["frame_stride"](spark, SF_SMALL)) == [("documents", ("doc_id", "text"))]
    assert scans(E.queries()["text_preview"](spark, SF_SMALL)) == [("documents", ("doc_id", "text"))]
    assert scans(E.queries()["base64_roundtrip"](spark, SF_SMALL)) == [("documents", ("doc_id", "text"))]


def test_one_scan_and_one_parse_per_table(spark):
    """Both levels of the running scan read one exchange."""
    for name, tables in [("txn_user_running", ["events"]), ("frame_source_running", ["documents"]),
                         ("file_type_running", ["conversations", "documents", "pages"]), ("frame_stride", ["documents"]),
                         ("pairwise_avg_window", ["documents"]), ("file_pairwise_avg_window", ["conversations", "documents", "pages"])]:
        df = E.queries()[name](spark, SF_SMALL)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        final = final[final.index("== Final Plan =="):].split("== Initial Plan ==")[0]
        assert len(re.findall(r"FileScan", final)) == len(tables), name
        assert "ReusedExchange" in final, name


def test_a_file_type_reads_its_own_table(spark):
    for name, table in [("file_video_analysis", "conversations"), ("file_doc_analysis", "documents"),
                        ("file_image_analysis", "pages"), ("video_duration", "conversations")]:
        assert [t for t, _ in scans(E.queries()[name](spark, SF_SMALL))] == [table], name


def test_parse_extracts_only_the_asked_members(spark):
    p = plan(E.queries()["frame_sizes"](spark, SF_SMALL), "extended")
    optimized = p[p.index("== Optimized Logical Plan =="):]
    generate = next(line for line in optimized.splitlines() if "Generate inline" in line)
    assert "frame_width" in generate
    assert "$.frame_data, string" not in generate and "$.metadata, map" not in generate


def test_no_python_in_builtin_paths(spark):
    for name in ["txn_category_window", "frame_resolution_window", "file_size_window",
                 "file_analysis", "txn_user_running"]:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_payload_not_shuffled(spark):
    """No payload column enters a hash exchange (formatted plan inputs)."""
    for name in ["frame_resolution_window", "file_type_totals", "file_size_window",
                 "frame_source_running", "file_type_running"]:
        p = plan(E.queries()[name](spark, SF_SMALL), "formatted")
        blocks = p.split("\n\n")
        hashed = [b for b in blocks if b.strip() and "Exchange" in b.strip().splitlines()[0]
                  and "hashpartitioning" in b]
        assert hashed, name
        for b in hashed:
            assert "frame_data" not in b and "file_content" not in b, name
