from __future__ import annotations

import pytest

#: Names that operators use inside or return; they must not clash with columns of the input.
CLASHING = "score shard slot fp h key term pos win size target taken source_size slice rank of len cell whole extra spans line_text n_lines n_removed n_pii component_id fingerprint variant root a b u v good held_out row key_of_row text_hash_of_row quality _quality pii_made pii_kinds made rest old state gone_id gone_starts _old _line_state _gone_id _key_of_row copies _copies _rows times n whole more part ahead i order of_id of_h of_n doc align at start bucket centre sig grams a.b c`d".split()


def words(n: int, start: int = 0) -> str:
    """n different words."""
    return " ".join(f"w{i}x" for i in range(start, start + n))


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, blank, repeated, tied and very long rows."""
    base = words(120)
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, " \t\n ", "en", "a"),
        (None, words(80, 500), "en", "b"), (None, None, None, None), (6, "\n".join([words(9, 900)] * 3 + ["Ünï code ß 漢字 line"] * 3), "de", "b"),
        (7, words(20_000, 10_000), "en", "a"), (8, "one", "en", None), (9, base + " end", "en", "c"), (7, "other text under a used id", "en", "a"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as long) as n_chars")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def crowded(docs):
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in dict.fromkeys(CLASHING) if c not in docs.columns])
