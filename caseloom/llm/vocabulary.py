"""Problem 2: mapping free-entered values to a canonical list.

A symmetric-delete dictionary of the list's wordings finds, for a typed value, every wording within the
bounded edit distance: the two share a string after at most that many deletions. Candidates are ranked by
weighted Damerau-Levenshtein distance, then by how often the wording is typed correctly. What surrounds a
wording without meaning anything ("since monday", "pt c/o") is learnt from the typed values themselves: it
stands beside wordings of several entries. Wordings typed correctly are found in the JVM; every other value is
looked up once, however often it is typed, and joined back.

The dictionary is broadcast while its size, which is measured, stays within a bound; beyond it the same
strings are a table and the look-up is a join.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import stored

UNMATCHED = "unmatched"

#: Bytes of a dictionary that is broadcast; a larger one is joined.
MAX_BROADCAST = 64 << 20

#: Rows of one value that a task joins; the results of values typed more often travel to their rows instead.
ROWS_PER_TASK = 1_000_000

#: Entries a context has to stand beside, and its longest length.
CONTEXT_ENTRIES, CONTEXT_CHARS = 3, 48

#: Never a mere context.
_NEGATIONS = {"no", "not", "non", "none", "never", "without", "denies", "denied", "deny", "negative"}
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_LOOKALIKE = str.maketrans("аеорсухіјѕһԁɡαοερνικτ", "aeopcyxijshdgaoepvikt")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"})
_AMOUNT = re.compile(r"^\d+(?:[.,]\d+)?(?:f|c|kg|kgs|lb|lbs|%)?[.,;]?$")
_PARTS = re.compile(r"\s*(?:,|;|/|&|\+|\band\b|\bwith\b|\bplus\b)\s*")
_SOUNDS = [("tion", "shun"), ("sion", "shun"), ("ough", "off"), ("ph", "f"), ("ch", "k"), ("ck", "k"), ("qu", "kw"), ("x", "ks"), ("c", "k"), ("ea", "ee"), ("y", "ie")]
_NEAR = {frozenset(p) for row in ("qwertyuiop", "asdfghjkl", "zxcvbnm") for p in zip(row, row[1:])}
_ALIKE = {frozenset(p) for p in ("ae", "ei", "iy", "ou", "ao", "ck", "sz", "fv", "bp", "dt", "mn", "gj", "ui", "eo", "ie")}
#: Letters taken for each other: those that sound alike, those beside each other on the keyboard.
_CHANGE = {x + y: w for pairs, w in ((_NEAR, 0.8), (_ALIKE, 0.6)) for p in pairs for x, y in permutations(p)}


def normal(text: str) -> str:
    """Compatibility forms, look-alike letters, case and white space made one; invisible characters dropped."""
    t = _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower().translate(_LOOKALIKE)
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    t = re.sub(r"\bcan'?t\b", "cannot", t.replace("’", "'"))
    return re.sub(r"\s+", " ", t).strip()


def _marks(text: str) -> str:
    return re.sub(r"^[\W_]+|[\W_]+$", "", text)


def _bounds(text: str) -> list[int]:
    """Where words begin or end."""
    return [m.start() for m in re.finditer(r"(?<=[^\W_])(?=[\W_])|(?<=[\W_])(?=[^\W_])", text)]


def residual(text: str) -> str:
    """One spelling of what stands beside a wording: numbers made one, no white space around."""
    return re.sub(r"\d+(?:[.,]\d+)?", "#", text).strip()


@dataclass(frozen=True)
class Contexts:
    """What may stand before and after a wording without changing what it means."""

    before: frozenset[str] = frozenset()
    after: frozenset[str] = frozenset()

    def stripped(self, text: str, leading: bool = True) -> str:
        """``text`` without contexts (``leading=False``: none before it) and without surrounding marks."""
        while True:
            t = _marks(text)
            # Bounds beyond the longest context are no candidates, so that long texts cost no more.
            cut = next((k for k in _bounds(t[-CONTEXT_CHARS:]) if residual(t[-CONTEXT_CHARS:][k:]) in self.after), None) if self.after else None
            if cut is not None and (rest := t[: max(0, len(t) - CONTEXT_CHARS) + cut].strip()):
                t = rest
            if leading and self.before:
                cut = next((k for k in reversed(_bounds(t[:CONTEXT_CHARS])) if residual(t[:k]) in self.before), None)
                if cut is not None and (rest := t[cut:].strip()):
                    t = rest
            if not t or t == text:
                return t or text
            text = t


def context_pairs(typed: str, known: dict[str, str], longest: int) -> list[tuple[str, str, str]]:
    """(side, residual, entry) of a value that holds one wording of the list, and something beside it."""
    text = _marks(normal(typed))
    if len(text) > longest + 2 * CONTEXT_CHARS:
        return []
    at = [0, *_bounds(text), len(text)]
    found = [(i, j) for n, i in enumerate(at) for j in at[n + 1 :] if j - i <= longest and text[i:j] in known]
    if not found:
        return []
    i, j = max(found, key=lambda x: (x[1] - x[0], -x[0]))
    out = []
    for side, rest, others in (("before", text[:i], [x for x in found if x[1] <= i]), ("after", text[j:], [x for x in found if x[0] >= j])):
        r = residual(rest)
        if r and len(r) <= CONTEXT_CHARS and not others and not _NEGATIONS & set(re.findall(r"[^\W\d_]+", r)):
            out.append((side, r, known[text[i:j]]))
    return out


def letters(text: str) -> str:
    """Only letters and digits, digits inside words read as the letters they stand for."""
    words = ["#" if _AMOUNT.match(w) else w.translate(_LEET) for w in text.split()]
    return re.sub(r"[^a-z#]", "", "".join(words))


def sound(key: str) -> str:
    for a, b in _SOUNDS:
        key = key.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", key)


def deletes(key: str, most: int) -> set[str]:
    """The string and what is left of it after up to ``most`` deletions."""
    out = last = {key}
    for _ in range(most):
        last = {s[:i] + s[i + 1 :] for s in last for i in range(len(s))}
        out = out | last
    return out


def weighted_distance(a: str, b: str, bound: float) -> float:
    """Damerau-Levenshtein, swapped letters may have others between them, with cheaper likely slips.

    Above ``bound`` any larger number."""
    if abs(len(a) - len(b)) > 2 * bound:
        return bound + 1
    step = lambda s: [0.5 if i and s[i - 1] == x else 1.0 for i, x in enumerate(s)]  # noqa: E731  a doubled letter
    insert = step(b)
    top = [0.0]
    for w in insert:
        top.append(top[-1] + w)
    d = [top]
    row_of: dict[str, int] = {}  # where a letter of b was last seen in a
    for i, (x, gap) in enumerate(zip(a, step(a))):
        above = d[i]
        left = above[0] + gap
        row = [left]
        last_same = -1
        for j, y in enumerate(b):
            if x == y:
                v = above[j]
            else:
                v = above[j] + _CHANGE.get(x + y, 1.0)
                k = row_of.get(y, -1)
                if k >= 0 and last_same >= 0 and (w := d[k][last_same] + (i - k - 1) + 0.8 + (j - last_same - 1)) < v:
                    v = w
            if (w := above[j + 1] + gap) < v:
                v = w
            if (w := left + insert[j]) < v:
                v = w
            if x == y:
                last_same = j
            left = v
            row.append(v)
        row_of[x] = i
        d.append(row)
        if min(row) > bound and min(above) > bound:
            return bound + 1
    return d[-1][-1]


def allowed(length: int) -> int:
    """Edits a wording of so many letters may have."""
    return 0 if length <= 3 else 1 if length <= 5 else 2 if length <= 11 else 3


Hit = tuple[str, str, int]  # key of a wording, entry, how often the wording is typed


def index_entries(symptom: str, wording: str, frequency: int, edits: int = 3) -> list[tuple[str, Hit]]:
    """(probe, hit) of a wording: itself (``e``), what deletions leave of it (``d``) and of its sound (``s``), and its
    number of words and first letters (``p``, with the words as key)."""
    text = normal(wording)
    key, words = letters(text), text.split()
    if not key:
        return []
    hit = (key, symptom, frequency)
    return [
        (f"e{key}", hit),
        *((f"d{d}", hit) for d in deletes(key, min(edits, allowed(len(key))))),
        *((f"s{d}", hit) for d in deletes(sound(key), 1)),
        (f"p{len(words)} {words[0][:3]}", (text, symptom, frequency)),
    ]


class SymmetricDelete:
    """The look-up. ``index``: probe -> hits, the whole dictionary or what a value's probes find of it."""

    def __init__(self, wordings: Iterable[tuple[str, str]] = (), frequency: dict[str, int] | None = None, aliases: dict[str, str] | None = None, edits: int = 3, contexts: Contexts | None = None, longest: int = 0):
        self.edits, self.contexts = edits, contexts or Contexts()
        self.index: dict[str, list[Hit]] = {}
        self.longest = longest  # letters of the longest wording: a value with many more is within no distance
        frequency = frequency or {}
        for symptom, wording in wordings:
            for probe, hit in index_entries(symptom, wording, frequency.get(listed_form(wording), 0), edits):
                self.index.setdefault(probe, []).append(hit)
            self.longest = max(self.longest, len(letters(normal(wording))))
        known = {s for s, _ in wordings}
        self.alias: dict[str, str] = {}
        for symptom, words in (aliases or {}).items():
            if symptom in known:
                for w in words.split("; "):
                    self.alias.setdefault(letters(normal(w)), symptom)

    def hits(self, probe: str) -> list[Hit]:
        return self.index.get(probe, ())

    def exact(self, text: str) -> str | None:
        key = letters(text)
        if not key:
            return None
        if found := self.hits(f"e{key}"):
            return min(found, key=lambda h: (-h[2], h[1]))[1]
        return self.alias.get(key)

    def close(self, text: str) -> str | None:
        """The best wording within the allowed edits, or with the same sound but for one edit."""
        key = letters(text)
        if not 4 <= len(key) <= self.longest + self.edits:
            return None
        found: dict[Hit, float] = {}
        seen: set[Hit] = set()
        for edits in range(min(2, self.edits), self.edits + 1):  # the wider search only where the narrow one finds nothing
            for d in deletes(key, min(edits, allowed(len(key)))):
                for hit in self.hits(f"d{d}"):
                    if (hit, edits) not in seen:
                        seen.add((hit, edits))
                        bound = min(allowed(len(hit[0])), allowed(len(key)), edits)
                        if abs(len(hit[0]) - len(key)) <= edits and (w := weighted_distance(key, hit[0], bound)) <= bound:
                            found[hit] = w
            if found:
                break
        heard = sound(key)
        for d in deletes(heard, 1):
            for hit in self.hits(f"s{d}"):
                if (hit, "s") not in seen:
                    seen.add((hit, "s"))
                    w = 0.3 + weighted_distance(heard, sound(hit[0]), 1)
                    if w <= (1.3 if len(hit[0]) > 5 else 0.8):
                        found[hit] = min(w, found.get(hit, 9))
        if not found:
            return self.cut_short(text)
        return min(found, key=lambda h: (found[h], -h[2], h))[1]

    def cut_short(self, text: str) -> str | None:
        """The one entry whose wording has, word for word, these beginnings (of three letters or more)."""
        words = [w.strip(".,;:") for w in text.split()]
        if min(map(len, words), default=0) < 3 or sum(map(len, words)) < 5:
            return None
        found = {s for t, s, _ in self.hits(f"p{len(words)} {words[0][:3]}") if all(p.startswith(w) for p, w in zip(t.split(), words))}
        return found.pop() if len(found) == 1 else None

    def resolve(self, typed: str) -> list[str]:
        """The entries a typed value means, in the order named; empty if none."""
        text = normal(typed)
        short = self.contexts.stripped(text)
        for t in dict.fromkeys((text, short)):
            if hit := self.exact(t):
                return [hit]
        swapped = None
        if short.count(",") == 1:
            a, b = short.split(",")
            swapped = f"{b.strip()} {a.strip()}"
            if hit := self.exact(swapped):
                return [hit]
        parts = [self.contexts.stripped(p) for p in _PARTS.split(short) if p.strip()]
        if len(parts) > 1:
            hits = [self.exact(p) for p in parts]
            if all(hits):
                return list(dict.fromkeys(hits))
        for t in (short, swapped, self.contexts.stripped(text, leading=False)):
            if t and (hit := self.close(t)):
                return [hit]
        if len(parts) > 1:
            return list(dict.fromkeys(h for p in parts if (h := self.exact(p) or self.close(p))))
        return []


class _Probes(SymmetricDelete):
    """Finds nothing and notes what it was asked for, so every way of :meth:`resolve` is gone."""

    def __init__(self, edits: int, contexts: Contexts, longest: int):
        super().__init__(edits=edits, contexts=contexts, longest=longest)
        self.asked: set[str] = set()

    def hits(self, probe: str) -> list[Hit]:
        self.asked.add(probe)
        return ()

    def of(self, typed: str) -> list[str]:
        self.asked = set()
        self.resolve(typed)
        return sorted(self.asked)


def listed_form(wording: str) -> str:
    """Trimmed and in lower case, white space as Spark's ``\\s``."""
    return re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", wording).lower()


def _listed_form(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def typed_terms(results: DataFrame) -> DataFrame:
    """extraction_id, term_no, typed of every element that is not NULL or blank."""
    terms = results.select("extraction_id", F.posexplode("symptoms").alias("pos", "typed")).select(
        "extraction_id", (F.col("pos") + 1).cast("int").alias("term_no"), "typed"
    )
    return terms.where(F.col("typed").isNotNull() & ~F.col("typed").rlike(r"\A\s*\z"))


def _vocabulary(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.select("symptom", "wording").where("symptom is not null and wording is not null").distinct()


def _in_batches(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield run(b)

    return df.mapInArrow(each, schema)


def learn_contexts(values: DataFrame, vocabulary: DataFrame, entries: int = CONTEXT_ENTRIES) -> Contexts:
    """What stands beside wordings of at least ``entries`` entries in the typed values (column ``typed``, each once).

    Only the contexts themselves come to the driver, each of at most ``CONTEXT_CHARS`` characters and backed by ``entries`` values."""
    words = {normal(r.wording): r.symptom for r in _vocabulary(vocabulary).orderBy(F.desc("symptom"), F.desc("wording")).collect()}
    longest = max(map(len, words), default=0)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [x for t in b.column("typed").to_pylist() for x in context_pairs(t, words, longest)]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.string()) for n in range(3)], ["side", "residual", "symptom"])

    pairs = _in_batches(values.select("typed"), run, "side string, residual string, symptom string").distinct()
    kept = pairs.groupBy("side", "residual").agg(F.count("*").alias("n")).where(F.col("n") >= entries).collect()
    return Contexts(*(frozenset(r.residual for r in kept if r.side == s) for s in ("before", "after")))


def index_table(vocabulary: DataFrame, frequency: DataFrame, edits: int = 3) -> DataFrame:
    """probe, key, symptom, frequency: the dictionary as a table. frequency: form (see :func:`listed_form`), n."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(p, *h) for s, w, n in zip(*(b.column(c).to_pylist() for c in ("symptom", "wording", "n"))) for p, h in index_entries(s, w, n or 0, edits)]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))], ["probe", "key", "symptom", "frequency"])

    v = _vocabulary(vocabulary).withColumn("form", _listed_form(F.col("wording"))).join(frequency, "form", "left")
    return _in_batches(v.select("symptom", "wording", "n"), run, "probe string, key string, symptom string, frequency bigint")


def _resolved(values: DataFrame, index: DataFrame, contexts: Contexts, aliases: dict[str, str] | None, symptoms: list[str], edits: int, max_broadcast: int) -> DataFrame:
    """typed, found (entries) of each value."""
    alias = {s: w for s, w in (aliases or {}).items() if s in set(symptoms)}

    def searcher(rows) -> SymmetricDelete:
        out = SymmetricDelete(edits=edits, contexts=contexts, longest=longest)
        for probe, *hit in rows:
            out.index.setdefault(probe, []).append(tuple(hit))
        for s, w in alias.items():
            out.alias |= {k: s for x in w.split("; ") if (k := letters(normal(x))) not in out.alias}
        return out

    schema = "typed string, found array<string>"
    as_batch = lambda typed, found: pa.RecordBatch.from_arrays([typed, pa.array(found, pa.list_(pa.string()))], ["typed", "found"])
    # 200: Python's objects around a string.
    size, longest = index.agg(F.coalesce(F.sum(F.length("probe") + F.length("key") + F.length("symptom") + 200), F.lit(0)), F.coalesce(F.max(F.when(F.startswith("probe", F.lit("e")), F.length("key"))), F.lit(0))).first()
    if size <= max_broadcast:
        shared = values.sparkSession.sparkContext.broadcast(searcher(map(tuple, index.collect())))
        return _in_batches(values.select("typed"), lambda b: as_batch(b.column("typed"), [shared.value.resolve(t) for t in b.column("typed").to_pylist()]), schema)

    def ask(b: pa.RecordBatch) -> pa.RecordBatch:
        asked = _Probes(edits, contexts, longest)
        rows = [(t, p) for t in b.column("typed").to_pylist() for p in asked.of(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.string()) for n in range(2)], ["typed", "probe"])

    hits = _in_batches(values.select("typed"), ask, "typed string, probe string").join(index, "probe")
    found = hits.groupBy("typed").agg(F.collect_list(F.struct("probe", "key", "symptom", "frequency")).alias("hits"))  # a value's own candidates

    def look(b: pa.RecordBatch) -> pa.RecordBatch:
        each = zip(b.column("typed").to_pylist(), b.column("hits").to_pylist())
        return as_batch(b.column("typed"), [searcher(tuple(h.values()) for h in hs or ()).resolve(t) for t, hs in each])

    return _in_batches(values.select("typed").join(found, "typed", "left"), look, schema)


def map_terms(
    results: DataFrame, vocabulary: DataFrame, aliases: dict[str, str] | None = None, edits: int = 3, max_broadcast: int = MAX_BROADCAST, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """extraction_id, term_no, typed, symptom, listed: one row for every entry a typed element means, else ``unmatched``;
    listed: whether the element is, trimmed and in lower case, a wording of the list.

    ``aliases``: entry -> further wordings (``"a; b"``, # for a number) that no edit distance reaches; none by default.
    Defined results: NULL and blank elements, NULL and empty lists give no row; an element that is a
    wording of the list gives its entry (the smallest, should several have it); repeated elements and rows each give
    their rows; very long elements are read whole (none is within the edit distance of a short wording); extra columns are ignored.
    """
    terms = typed_terms(results)
    values = stored(terms.groupBy("typed").agg(F.count("*").alias("n")).withColumn("form", _listed_form(F.col("typed"))), "typed-values")
    entries = _vocabulary(vocabulary).groupBy(_listed_form(F.col("wording")).alias("form")).agg(F.min("symptom").alias("entry"))
    known = stored(values.join(entries, "form", "left"), "known-values")
    frequency = known.where("entry is not null").groupBy("form").agg(F.sum("n").alias("n"))
    unknown = known.where("entry is null")
    contexts = learn_contexts(unknown, vocabulary)
    index = stored(index_table(vocabulary, frequency, edits), "deletes")
    symptoms = [r.symptom for r in vocabulary.select("symptom").where(F.col("symptom").isin(list(aliases))).distinct().collect()] if aliases else []
    # Dealt out by a hash, so that no task has most of the values.
    spread_out = unknown.repartition(values.sparkSession.sparkContext.defaultParallelism) if unknown.count() else unknown
    found = _resolved(spread_out, index, contexts, aliases, symptoms, edits, max_broadcast)
    looked_up = found.select("typed", F.when(F.size("found") > 0, F.col("found")).otherwise(F.array(F.lit(UNMATCHED))).alias("found"), F.lit(False).alias("listed"))
    listed = known.where("entry is not null").select("typed", F.array("entry").alias("found"), F.lit(True).alias("listed"))
    answers = stored(looked_up.unionByName(listed), "resolved")
    # A value typed in very many rows travels to them: there are no more of those than rows / rows_per_task.
    hot = values.where(F.col("n") > rows_per_task).select("typed")
    if hot.isEmpty():
        joined = terms.join(answers, "typed")
    else:
        often = answers.join(hot, "typed", "left_semi")
        joined = terms.join(F.broadcast(often), "typed").unionByName(
            terms.join(F.broadcast(hot), "typed", "left_anti").join(answers.join(hot, "typed", "left_anti"), "typed")
        )
    return joined.select("extraction_id", "term_no", "typed", F.explode("found").alias("symptom"), "listed")


def dirty_terms(results: DataFrame, vocabulary: DataFrame, **kwargs) -> DataFrame:
    """:func:`map_terms` for the elements that are not a wording already."""
    return map_terms(results, vocabulary, **kwargs).where(~F.col("listed")).drop("listed")


def as_lists(mapped: DataFrame) -> DataFrame:
    """extraction_id, symptoms_mapped (sorted, each once) and unmapped_terms (as typed, in their order)."""
    missed = F.col("symptom") == UNMATCHED
    lost = F.array_sort(F.collect_list(F.when(missed, F.struct("term_no", "typed"))))
    return mapped.groupBy("extraction_id").agg(
        F.array_sort(F.collect_set(F.when(~missed, F.col("symptom")))).alias("symptoms_mapped"),
        F.transform(lost, lambda x: x["typed"]).alias("unmapped_terms"),
    )


def unmatched_report(mapped: DataFrame) -> DataFrame:
    """Unmatched values in one spelling, with how often and in how many extractions they were typed."""
    return (
        mapped.where(F.col("symptom") == UNMATCHED)
        .groupBy(F.regexp_replace(F.lower(F.trim("typed")), r"\s+", " ").alias("term"))
        .agg(F.count("*").alias("times"), F.countDistinct("extraction_id").alias("extractions"))
    )
