"""A generator of case messages. Every draw is a hash of what it is for, so the same seed gives the same
data on any cluster and in any order of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTIES = ["Alderbrook", "Fennmoor", "Quarrydale", "Redthorn", "Ostergate", "Umberton"]
CONDITIONS = [("990014007", "Norovirus infection", 1.6), ("990022003", "Campylobacteriosis", 0.9), ("990063002", "RSV infection", 1.3), ("990096000", "Measles", 0.2), ("990108004", "Tuberculosis", 0.3), ("990127001", "Dengue", 0.15)]
SYMPTOMS = ["fever", "cough", "nausea", "diarrhea", "fatigue", "sore throat", "abdominal cramps", "myalgia"]
PLACES = ["wedding buffet", "swimming lake", "petting farm", "street market", "care home"]
NAMES = ["Harbour", "Millbrook", "Larkfield", "Stonegate", "Westmere"]
KINDS = ["Hospital", "Clinic", "Laboratory", "Health Centre"]
WEEKEND = 0.45


def uniform(*parts: Column | str, salt: str, seed: int) -> Column:
    """A draw from [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts, F.lit(salt), F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)


def choice(values: list[str], *parts, salt: str, seed: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(uniform(*parts, salt=salt, seed=seed) * len(values)) + 1).cast("int"))


def facilities(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    f = spark.range(1, n + 1).select(F.format_string("FX%06d", "id").alias("facility_id"), "id")
    return f.select(
        "facility_id", F.concat(choice(NAMES, "id", salt="name", seed=seed), F.lit(" "), choice(KINDS, "id", salt="kind", seed=seed), F.lit(" "), F.col("id").cast("string")).alias("name"),
        F.element_at(F.array(*map(F.lit, COUNTIES)), (F.col("id") % len(COUNTIES) + 1).cast("int")).alias("county"),
        (0.7 + 1.5 * uniform("id", salt="volume", seed=seed)).alias("volume"),
    )


def outbreak_windows(spark: SparkSession, days: int, n_facilities: int, end: str, seed: int = 42) -> DataFrame:
    """At least 8 windows of 7 to 18 days that multiply cases by 3.5 to 8."""
    w = spark.range(max(8, days // 12))
    u = lambda salt: uniform("id", salt=salt, seed=seed)
    start = F.date_sub(F.lit(end).cast("date"), F.floor(u("start") * days).cast("int"))
    return w.select(
        F.format_string("FX%06d", (F.floor(u("facility") * n_facilities) + 1)).alias("facility_id"), choice([c[1] for c in CONDITIONS], "id", salt="condition", seed=seed).alias("condition_name"),
        start.alias("start_date"), F.date_add(start, (F.floor(u("length") * 12) + 6).cast("int")).alias("end_date"), F.round(3.5 + 4.5 * u("times"), 2).alias("multiplier"),
    )


def poisson(mean: Column, u: Column) -> Column:
    """The inverse of the distribution function at u, by a fold over as many terms as the mean needs."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    step = lambda acc, k: F.struct(
        (acc["p"] * mean / k).alias("p"), (acc["cdf"] + acc["p"] * mean / k).alias("cdf"), F.when(u > acc["cdf"], k.cast("int")).otherwise(acc["n"]).alias("n")
    )
    first = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(1), most).cast("array<double>"), first, step, lambda a: a["n"])


def case_plan(spark: SparkSession, days: int, n_facilities: int, end: str, seed: int = 42) -> DataFrame:
    """One row per case: day, facility, condition, sequence number."""
    from caseloom.operators.features import multiplier_at

    kinds = F.array(*[F.struct(F.lit(c).alias("condition_code"), F.lit(n).alias("condition_name"), F.lit(b).alias("base")) for c, n, b in CONDITIONS])
    last = F.lit(end).cast("date")
    panel = facilities(spark, n_facilities, seed).select("*", F.inline(kinds)).select("*", F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("report_date"))
    rated = multiplier_at(panel, outbreak_windows(spark, days, n_facilities, end, seed))
    mean = F.col("base") * F.col("volume") * F.when(F.dayofweek("report_date").isin(1, 7), WEEKEND).otherwise(1.0) * F.col("multiplier")
    n = poisson(mean, uniform("facility_id", "condition_code", "report_date", salt="count", seed=seed))
    return rated.withColumn("n", n).where("n > 0").withColumn("seq", F.explode(F.sequence(F.lit(1), F.col("n"))))


def with_payload(cases: DataFrame, seed: int = 42) -> DataFrame:
    """Adds the five-segment message and the facts of its note."""
    key = ("facility_id", "condition_code", "report_date", "seq")
    u = lambda salt: uniform(*key, salt=salt, seed=seed)
    pick = lambda values, salt: choice(values, *key, salt=salt, seed=seed)
    day = lambda c: F.date_format(c, "yyyyMMdd")
    c = cases.withColumns({
        "onset_date": F.date_sub("report_date", (2 + F.floor(u("onset") * 8)).cast("int")), "age": (1 + F.floor(u("age") * 91)).cast("int"), "sex": pick(["M", "F"], "sex"),
        "s1": pick(SYMPTOMS[:4], "s1"), "s2": pick(SYMPTOMS[4:], "s2"), "exposure": pick(PLACES, "place"), "travel": u("travel") < 0.18,
        "message_ts": F.concat(day("report_date"), F.lpad(F.floor(u("hour") * 24).cast("string"), 2, "0"), F.lit("1500")),
    }).withColumns({
        "birth_date": F.add_months("report_date", -12 * F.col("age")), "collected": F.date_add("onset_date", (F.floor(u("collect") * 4)).cast("int")),
        "patient_key": F.substring(F.sha2(F.concat_ws("/", *key), 256), 1, 12),
        "control_id": F.concat(F.lit("G"), F.substring("facility_id", 3, 6), F.substring("condition_code", 4, 3), day("report_date"), F.lpad(F.col("seq").cast("string"), 3, "0")),
    })
    note = F.concat(
        F.lit("Aged "), F.col("age").cast("string"), F.lit(", presenting with "), "s1", F.lit(" and "), "s2", F.lit(". Symptom onset reported as "), F.col("onset_date").cast("string"),
        F.lit(". Exposure history: "), "exposure", F.when(F.col("travel"), ". Reports recent travel abroad.").otherwise(". Denies travel."),
    )
    seg = lambda *fields: F.concat_ws("|", *[f if isinstance(f, Column) else F.lit(f) for f in fields])
    comp = lambda *parts: F.concat_ws("^", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    payload = F.concat_ws(
        "\r",
        seg("MSH", "^~\\&", "LOOM", F.col("facility_id"), "ECR", "AX", F.col("message_ts"), "", "ORU^R01", F.col("control_id"), "P", "2.5.1"),
        seg("PID", "1", "", comp(F.col("patient_key"), "", "", F.col("facility_id"), "MR"), "", "ROE^PATIENT", "", day("birth_date"), F.col("sex"), "", "", comp("1 MILL ROAD", "", F.col("county"), "AX", "10001")),
        seg("OBR", "1", "", F.concat(F.lit("RQ"), F.col("control_id")), "", "PCR^Nucleic acid test^L", "", day("collected")),
        seg("OBX", "1", "CWE", comp(F.col("condition_code"), F.col("condition_name"), "LOC"), "", "POS^Positive^LOC", "", "", "A", "", "", "F", "", "", day("report_date")),
        seg("NTE", "1", "", note),
    )
    return c.withColumns({"note": note, "payload_hl7": payload})


def corrupt(payload: Column, kind: Column) -> Column:
    """0 drops the observation, 1 zeroes the timestamp, 2 keeps the header, 3 keeps two segments; else as it is."""
    parts = F.split(payload, "\r")
    return (
        F.when(kind == 0, F.regexp_replace(payload, r"\rOBX\|[^\r]*", ""))
        .when(kind == 1, F.regexp_replace(payload, r"\A((?:[^|\r]*\|){6})[0-9]{14}", "$100000000000000"))
        .when(kind == 2, F.element_at(parts, 1))
        .when(kind == 3, F.array_join(F.slice(parts, 1, 2), "\r"))
        .otherwise(payload)
    )


def messages(spark: SparkSession, days: int = 240, facilities: int = 12, end: str = "2026-06-30", dup_rate: float = 0.04, corrupt_rate: float = 0.025, seed: int = 42) -> DataFrame:
    """Landing rows: message_id, source_system, received_at, payload_hl7, ingest_date. A share is damaged, a share sent again 1 to 30 hours later."""
    key = ("facility_id", "condition_code", "report_date", "seq")
    made = with_payload(case_plan(spark, days, facilities, end, seed), seed)
    bad = uniform(*key, salt="corrupt", seed=seed)
    made = made.withColumn("payload_hl7", corrupt(F.col("payload_hl7"), F.when(bad < corrupt_rate, F.floor(bad / corrupt_rate * 4).cast("int")).otherwise(-1)))
    again = uniform(*key, salt="again", seed=seed)
    hours = (1 + F.floor(again / dup_rate * 30)).cast("int")
    copies = F.when(again < dup_rate, F.array(F.lit(0), hours)).otherwise(F.array(F.lit(0)))
    sent = made.select("*", F.explode(copies).alias("hours"))
    received = F.col("report_date").cast("timestamp") + F.make_interval(hours=F.col("hours") + 9)
    return sent.select(
        F.sha2(F.concat_ws("|", "control_id", F.col("hours").cast("string")), 256).alias("message_id"), F.concat(F.lit("LOOM_"), F.substring("facility_id", 3, 6)).alias("source_system"),
        F.date_format(received, "yyyy-MM-dd'T'HH:mm:ss").alias("received_at"), "payload_hl7", F.date_format(received, "yyyy-MM-dd").alias("ingest_date"),
    )


def golden_sample(spark: SparkSession, days: int = 240, facilities: int = 12, end: str = "2026-06-30", rate: float = 0.05, most: int = 120, seed: int = 42) -> DataFrame:
    """Notes with their facts, for evaluation: a sample is the feature."""
    made = with_payload(case_plan(spark, days, facilities, end, seed), seed)
    drawn = uniform("control_id", salt="golden", seed=seed)
    want = F.struct(F.array_sort(F.array("s1", "s2")).alias("symptoms"), F.col("onset_date").cast("string").alias("onset_date"), F.col("exposure").alias("exposure_setting"), F.col("travel").alias("recent_travel"))
    return made.where(drawn < rate).orderBy(drawn, "control_id").limit(most).select(F.col("control_id").alias("message_control_id"), "note", want.alias("expected"))
