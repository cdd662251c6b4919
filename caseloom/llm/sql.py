"""SQL of the queries on texts, where SQL can express them. Fuzzy lookup, the containers themselves, seeded selection and
compression have none: they are tested against brute force, exact properties and held-out labels in ``tests/llm``."""

SQL: dict[str, str] = {
    "p2_listed": """WITH words AS (SELECT lower(trim(wording)) AS form, min(symptom) AS symptom FROM symptom_vocabulary GROUP BY 1),
terms AS (SELECT extraction_id, generate_subscripts(symptoms, 1) AS term_no, unnest(symptoms) AS typed FROM extraction_results)
SELECT extraction_id, CAST(term_no AS INTEGER) AS term_no, words.symptom
FROM terms JOIN words ON words.form = lower(regexp_replace(typed, '^\\s+|\\s+$', '', 'g'))""",
    "p7_cover": """SELECT capacity_id, capacity_tokens AS capacity, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS needless_cuts, 0 AS overfull
FROM pack_capacities WHERE capacity_tokens > 0""",
    "p8_cover": "SELECT regexp_replace(lower(trim(source)), '[\\s-]+', '_', 'g') AS source, max_repeats, 0 AS over_repeated, 0 AS later_copies FROM mix_targets",
}
