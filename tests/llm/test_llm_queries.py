"""Properties of the text queries on the smallest tables."""

from collections import Counter

import duckdb
import pytest
from oracle import DATA, compare

from caseloom.llm.queries import QUERIES, SQL

D = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_runs(spark, name):
    assert compare(spark, name, QUERIES[name], SQL.get(name), D)[2] is None


def test_found_terms_are_exactly_the_dirty_ones(spark):
    words = {r[0] for r in duckdb.sql(f"SELECT lower(trim(wording)) FROM '{D}/symptom_vocabulary.parquet'").fetchall()}
    symptoms = {r[0] for r in duckdb.sql(f"SELECT symptom FROM '{D}/symptom_vocabulary.parquet'").fetchall()} | {"unmatched"}
    want = {(i, n) for i, s in duckdb.sql(f"SELECT extraction_id, symptoms FROM '{D}/extraction_results.parquet'").fetchall() for n, t in enumerate(s or [], 1) if t and t.strip() and t.strip().lower() not in words}
    rows = QUERIES["p2_found"](spark, D).collect()
    assert {(r.extraction_id, r.term_no) for r in rows} == want and {r.symptom for r in rows} <= symptoms
    assert max(Counter(map(tuple, rows)).values()) == 1


def test_all_documents_are_packed(spark):
    rows = QUERIES["p7_pack"](spark, D).collect()
    n = duckdb.sql(f"SELECT count(*) FROM '{D}/documents.parquet'").fetchall()[0][0]
    caps = dict(duckdb.sql(f"SELECT capacity_id, capacity_tokens FROM '{D}/pack_capacities.parquet'").fetchall())
    load = Counter()
    for r in rows:
        load[(r.capacity_id, r.container_id)] += r.tokens
    assert all(v <= caps[c] for (c, _), v in load.items())
    assert all(len({r.doc_id for r in rows if r.capacity_id == c}) == n for c in caps)


def test_mix_respects_repeats(spark):
    cap = dict(duckdb.sql(f"SELECT source, max_repeats FROM '{D}/mix_targets.parquet'").fetchall())
    assert all(0 < r.repeats <= cap[r.source] for r in QUERIES["p8_mix"](spark, D).collect())
