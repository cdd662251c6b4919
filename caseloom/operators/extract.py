"""Facts from clinical notes: a rule backend, vocabulary mapping, grounding, and the validate-and-retry loop."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import Settings
from caseloom.sources.remote import RemoteModel

#: Canonical term -> accepted wordings.
VOCABULARY = {
    "diarrhea": ["diarrhea", "diarrhoea", "loose stools", "watery stools"],
    "bloody diarrhea": ["bloody diarrhea", "bloody stools", "hematochezia"],
    "abdominal cramps": ["abdominal cramps", "abdominal pain", "stomach cramps", "tummy ache"],
    "fever": ["fever", "febrile", "pyrexia", "elevated temperature"],
    "nausea": ["nausea", "queasiness"],
    "vomiting": ["vomiting", "emesis", "post-tussive vomiting"],
    "jaundice": ["jaundice", "icterus", "yellowing of skin"],
    "fatigue": ["fatigue", "tiredness", "malaise"],
    "dark urine": ["dark urine", "tea-colored urine"],
    "cough": ["cough", "coughing"],
    "paroxysmal cough": ["paroxysmal cough", "coughing fits", "whooping cough"],
    "whoop": ["whoop", "inspiratory whoop"],
    "myalgia": ["myalgia", "muscle aches", "body aches"],
    "sore throat": ["sore throat", "pharyngitis"],
    "loss of taste": ["loss of taste", "ageusia", "loss of taste or smell"],
    "shortness of breath": ["shortness of breath", "dyspnea", "difficulty breathing"],
}

#: Terms the rule backend looks for, in its order.
LEXICON = [
    "bloody diarrhea", "bloody stools", "loose stools", "watery stools", "diarrhea", "abdominal cramps", "stomach cramps",
    "abdominal pain", "fever", "febrile", "nausea", "jaundice", "fatigue", "dark urine", "paroxysmal cough", "coughing fits",
    "whoop", "post-tussive vomiting", "cough", "myalgia", "muscle aches", "body aches", "sore throat", "loss of taste",
    "shortness of breath", "dyspnea",
]
#: How a note states onset, exposure and travel, in lower case.
ONSET, EXPOSURE, TRAVEL = r"onset reported as (\d{4}-\d{2}-\d{2})", r"exposure history: ([^.]+)\.", "reports recent travel"
MAX_ATTEMPTS = 3

#: What a model is asked for; a parameter of the extraction.
INSTRUCTION = (
    "Read the clinical note and answer with one JSON object: symptoms (list of texts as written), onset_date (ISO date in the note, or null), "
    "exposure_setting (text or null), recent_travel (true or false), confidence (high, medium or low). State nothing the note does not say."
)


def lexicon_terms(note: Column) -> Column:
    """Terms of the lexicon in a note, sorted; a term inside a longer one found before it does not count.

    Whether a term is hidden by an earlier one depends only on fixed lists, so each term is one
    condition in generated code; a term is hidden if any earlier term that contains it was itself kept.
    """
    kept: dict[str, Column] = {}
    for term in LEXICON:
        present = F.contains(note, F.lit(term))
        for longer in [t for t in kept if term in t and t != term]:
            present = present & ~kept[longer]
        kept[term] = present
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(t)) for t, c in kept.items()])))


def rule_extract(df: DataFrame, note: str = "note") -> DataFrame:
    """Adds symptoms, onset_date, exposure_setting, recent_travel by the rule backend."""
    low = F.lower(F.col(note))
    found = lambda p: F.nullif(F.regexp_extract(low, p, 1), F.lit(""))
    return df.withColumns({
        "symptoms": lexicon_terms(low), "onset_date": found(ONSET),
        "exposure_setting": F.trim(found(EXPOSURE)), "recent_travel": F.contains(low, F.lit(TRAVEL)),
    })


def rule_reply(note: Column) -> Column:
    """The rule backend's answer as JSON text, in the form a model is asked for."""
    facts = {
        "symptoms": lexicon_terms(F.lower(note)), "onset_date": F.nullif(F.regexp_extract(F.lower(note), ONSET, 1), F.lit("")),
        "exposure_setting": F.nullif(F.trim(F.regexp_extract(F.lower(note), EXPOSURE, 1)), F.lit("")), "recent_travel": F.coalesce(F.contains(F.lower(note), F.lit(TRAVEL)), F.lit(False)),
        "confidence": F.lit("high"),
    }
    return F.to_json(F.struct(*[c.alias(n) for n, c in facts.items()]), {"ignoreNullFields": "false"})


def longest_first(vocabulary: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(wording, canonical term) in the order wordings are looked for inside a term; ties alphabetically."""
    return sorted(((w, c) for c, ws in vocabulary.items() for w in ws), key=lambda x: (-len(x[0]), x[0]))


def vocabulary_entry(term: Column, vocabulary: dict[str, list[str]] = VOCABULARY) -> Column:
    """The canonical term of a wording, else of the longest wording it contains (ties alphabetically), else NULL."""
    wordings = longest_first(vocabulary)
    exact = F.element_at(F.create_map(*[F.lit(x) for w, c in wordings for x in (w, c)]), term)
    inside = F.coalesce(*[F.when(F.contains(term, F.lit(w)), F.lit(c)) for w, c in wordings])
    return F.coalesce(exact, inside)


def map_symptoms(df: DataFrame, key: str, terms: str = "symptoms") -> DataFrame:
    """Adds symptoms_mapped (sorted, each once) and unmapped_terms (in their order) to rows with a unique key."""
    clean = F.filter(F.transform(terms, lambda t: F.lower(F.trim(t))), lambda t: t != "")
    pairs = F.transform(clean, lambda t: F.struct(t.alias("t"), vocabulary_entry(t).alias("c")))
    return df.withColumn("_p", pairs).withColumns({
        "symptoms_mapped": F.array_sort(F.array_distinct(F.transform(F.filter("_p", lambda p: p["c"].isNotNull()), lambda p: p["c"]))),
        "unmapped_terms": F.transform(F.filter("_p", lambda p: p["c"].isNull()), lambda p: p["t"]),
    }).drop("_p")


def grounded(day: Column, note: Column) -> Column:
    """Whether a date occurs in the note as ISO text. No date is no claim."""
    return day.isNull() | F.coalesce(F.contains(note, day.cast("string")), F.lit(False))


def parse_reply(text: str) -> dict:
    """A reply as checked fields; raises ValueError with the reason. Code fences are tolerated."""
    body = re.sub(r"\A\s*```[a-z]*|```\s*\Z", "", text.strip()).strip()
    got = json.loads(body)
    if not isinstance(got, dict):
        raise ValueError("reply is not an object")
    symptoms = got.get("symptoms", [])
    if not isinstance(symptoms, list) or not all(isinstance(s, str) for s in symptoms):
        raise ValueError("symptoms is not a list of texts")
    travel, how = got.get("recent_travel", False), got.get("confidence", "medium")
    if not isinstance(travel, bool):
        raise ValueError("recent_travel is not a truth value")
    if how not in ("high", "medium", "low"):
        raise ValueError("confidence is not high, medium or low")
    onset = got.get("onset_date")
    where = got.get("exposure_setting")
    return {
        "symptoms": [s.strip().lower() for s in symptoms if s.strip()], "onset_date": date.fromisoformat(onset) if onset is not None else None,
        "exposure_setting": (where or "").strip().lower() or None, "recent_travel": travel, "confidence": how,
    }


def to_canonical(raw: list[str], vocabulary: dict[str, list[str]] = VOCABULARY) -> tuple[list[str], list[str]]:
    """(canonical terms sorted, misses in order) of plain texts, in the order of :func:`longest_first`."""
    ranked = longest_first(vocabulary)
    exact = dict(ranked)
    terms = [t.strip().lower() for t in raw]
    entries = [exact.get(t) or next((c for w, c in ranked if w in t), None) for t in terms]
    return sorted({e for e in entries if e}), [t for t, e in zip(terms, entries) if e is None]


def judged(reply: str, note: str) -> tuple[dict | None, str | None]:
    """(checked fields, None) of a reply that is valid and grounded in its note, else (None, what is wrong with it)."""
    try:
        fields = parse_reply(reply)
    except ValueError as x:
        return None, str(x)
    onset = fields["onset_date"]
    return (fields, None) if onset is None or str(onset) in note else (None, f"the note has no date {onset}")


def _record(fields: dict | None, faults: list[str], model: str) -> dict:
    """A row of EXTRACTION_SCHEMA: the facts, or an empty one that says why there are none."""
    mapped, missed = to_canonical(fields["symptoms"]) if fields else ([], [])
    known = fields or {"onset_date": None, "exposure_setting": None, "recent_travel": False, "confidence": "medium"}
    return {
        "symptoms_mapped": mapped, "unmapped_terms": missed, **{k: known[k] for k in ("onset_date", "exposure_setting", "recent_travel", "confidence")},
        "attempts": len(faults) + bool(fields), "extraction_failed": fields is None, "failure_reason": None if fields else faults[-1], "model": model,
    }


def extract_note(note: str, complete: Callable[[str, str], str], model: str = "unknown", attempts: int = MAX_ATTEMPTS, instruction: str = INSTRUCTION) -> dict:
    """The facts of one note by ``complete(instruction, message)``; what was wrong with earlier replies goes into the next message."""
    faults: list[str] = []
    while len(faults) < attempts:
        heard = "".join(f"\n(An earlier reply was not accepted: {f})" for f in faults[-1:])
        fields, fault = judged(complete(instruction, note + heard), note)
        if fields:
            return _record(fields, faults, model)
        faults.append(fault)
    return _record(None, faults, model)


EXTRACTION_SCHEMA = (
    "symptoms_mapped array<string>, unmapped_terms array<string>, onset_date date, exposure_setting string, recent_travel boolean, "
    "confidence string, attempts int, extraction_failed boolean, failure_reason string, model string"
)


def extract_notes(df: DataFrame, key: str, complete: Callable[[str, str], str], note: str = "note", model: str = "unknown") -> DataFrame:
    """:func:`extract_note` over a table in Arrow batches: the only way a remote model can be asked, with its retries."""
    source = df.select(F.col(key).alias("key"), F.col(note).alias("note"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([{"key": k} | extract_note(n or "", complete, model) for k, n in zip(b["key"], b["note"])], columns=["key", *[c.split()[0] for c in EXTRACTION_SCHEMA.split(", ")]])

    return source.mapInPandas(run, f"key {source.schema['key'].dataType.simpleString()}, {EXTRACTION_SCHEMA}").withColumnRenamed("key", key)


def extract_all(df: DataFrame, key: str, settings: Settings, note: str = "note") -> DataFrame:
    """``key`` and EXTRACTION_SCHEMA by the backend of the settings: the rules stay in the JVM, a remote model is asked in batches."""
    if settings.llm_backend == "remote":
        return extract_notes(df, key, RemoteModel(settings.llm_url, settings.model_deployment), note, settings.model_deployment)
    found = map_symptoms(rule_extract(df.select(F.col(key), F.coalesce(note, F.lit("")).alias("note"))), key)
    onset = F.col("onset_date").try_cast("date")
    why = F.when(F.col("onset_date").isNotNull() & onset.isNull(), "onset_date is no date").when(~grounded(onset, F.col("note")), "onset_date is not in the note")
    ok = why.isNull()
    none = F.array().cast("array<string>")
    return found.select(
        key, F.when(ok, F.col("symptoms_mapped")).otherwise(none).alias("symptoms_mapped"), F.when(ok, F.col("unmapped_terms")).otherwise(none).alias("unmapped_terms"),
        F.when(ok, onset).alias("onset_date"), F.when(ok, F.nullif("exposure_setting", F.lit(""))).alias("exposure_setting"), (ok & F.col("recent_travel")).alias("recent_travel"),
        F.when(ok, "high").otherwise("medium").alias("confidence"), F.lit(1).alias("attempts"), (~ok).alias("extraction_failed"), why.alias("failure_reason"), F.lit("rules").alias("model"),
    )
