from __future__ import annotations

from riskweave.llm import line_dedup as ld


def brute(rows, width=3):
    """Rows in order of (id, text hash) as given: ids are unique here."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lines = (text or "").split("\n")
        worded = [(i, x.strip(" ")) for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for s in range(max(len(worded) - width + 1, 1) if worded else 0):
            part = worded[s : s + width]
            window = tuple(x for _, x in part)
            if window in seen:
                gone |= {i for i, _ in part}
            seen.add(window)
        out[doc] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(worded), len(gone))
    return out


A, B, C, D = "first line here", "second line", "third line", "fourth"


def test_against_brute_force(spark, docs, crowded, nothing):
    rows = [
        (1, "\n".join([A, B, C, D])), (2, "\n".join(["own", A, B, C, "rest"])), (3, "\n".join([A, "", B, " \t", "  " + C, D])), (4, None), (5, ""), (6, A), (7, A), (8, f"{A}\n{B}"),
        (9, "\n".join([A, B, A, B, A, B, A])), (10, "\n".join([B, C, D])), (11, "\n" * 5), (None, "\n".join([A, B, C])), (12, f"{A}\n{B}"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as at", "2 as s", "3 as gone_id", "4 as state")
    got = {r.doc_id: (r.line_text, r.n_lines, r.n_removed) for r in ld.marked(df).collect()}
    assert got == brute(rows)
    assert ld.marked(docs).count() == docs.count()
    assert ld.marked(nothing).collect() == []
    assert ld.clean(crowded).columns == crowded.columns
    assert {r["n_lines"] for r in ld.clean(crowded).collect()} == {"mine n_lines"}


def test_repeated_rows_share_a_result(spark):
    df = spark.createDataFrame([(1, "\n".join([A, B, C]))] * 3 + [(2, "\n".join([A, B, C]))], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in ld.marked(df).collect())
    assert got == [(1, 0), (1, 0), (1, 0), (2, 3)]


def test_a_very_long_repeated_text(spark):
    text = "\n".join(f"line {i}" if i % 7 else "" for i in range(60_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nanother line")], "doc_id long, text string")
    rows = {r.doc_id: r for r in ld.marked(df).collect()}
    worded = sum(1 for i in range(60_000) if i % 7)
    assert (rows[1].n_removed, rows[1].line_text) == (0, text)
    assert (rows[2].n_lines, rows[2].n_removed) == (worded + 1, worded)
    assert rows[2].line_text == "\n" * (60_000 - worded) + "another line"
