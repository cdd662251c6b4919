"""Problem 9: abusive, hateful and sexual content, by compression distance.

Separate zstandard dictionaries are trained on ordinary text, on toxic text, and on the text of each category. A
window of a document costs so many bytes under each; what toxic text saves against ordinary text, per character,
is the window's score, for the category whose dictionary costs least. A document's score is that of its best
window. Thresholds are calibrated on reviewed documents that the dictionaries did not see (cross-fitting).

Reviews name documents, not sentences. The windows to learn from are those of flagged documents that
ordinary text compresses badly and that hold a word rare in ordinary documents; each goes to the category
that the labels of other documents with the same words speak for. No sentence of any category is built in.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tokens import spread
from caseloom.session import stored

CATEGORIES = ("abusive", "hateful", "sexual")

#: Labelled documents read for fitting, in the order of a hash of doc_id, and the characters of their texts. Scoring reads everything.
MAX_REVIEWED, MAX_REVIEWED_CHARS = 20_000, 64_000_000

_TAG = re.compile(r"<[^<>]{1,200}>|&#?\w{2,8};")
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_ALIKE = str.maketrans("аеорсухіјѕһԁɡαοερνικτ", "aeopcyxijshdgaoepvikt")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SPELT = re.compile(r"(?<![^\W_])[^\W\d_](?:([ ._\-*])[^\W\d_])(?:\1[^\W\d_])+(?![^\W_])")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
_MOJIBAKE = re.compile("[ÃÂâ][\u0080-¿‘-™]|Ã.")
_CODED = re.compile(r"[0-9@$!]")
_OVERHEAD, _SHORTEST, _WORDS, _STEP, _LEVEL, _TYPICAL = 4, 16, 12, 6, 16, 128


def _least_cost(window: str) -> int:
    """No frame of a window is shorter, overhead taken off: descriptors and block header (5 bytes) with the text as it is, with
    one repeated character, or with the heads and the least content of a block's two sections (4 bytes)."""
    return min(5, 1 + len(window)) if len(set(window)) > 1 else 2


def clean(text: str) -> str:
    """One spelling: mark-up, invisible and look-alike characters, accents, spelt-out and stretched words, digits in words."""
    t = _TAG.sub(" ", text) if "<" in text or "&" in text else text
    if t.isascii():
        t = t.lower()
    else:
        if _MOJIBAKE.search(t):
            try:
                t = t.encode("cp1252").decode("utf-8")
            except UnicodeError:
                pass
        t = _HIDDEN.sub("", unicodedata.normalize("NFKC", t)).lower().translate(_ALIKE).replace("’", "'")
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    t = _SPELT.sub(lambda m: re.sub(r"[ ._\-*]", "", m[0]), t)
    t = re.sub(r"([a-z])\1{2,}", r"\1", t)
    words = re.sub(r"!+1*(?=\s|$)", "!", t).split()
    if _CODED.search(t):
        for n, w in enumerate(words):
            if _CODED.search(w):
                if _CODED.search(w[:-1]) and re.search(r"[a-z]", w):
                    w = w[:-1].translate(_LEET) + w[-1]
                words[n] = re.sub(r"\d+", "0", w)
    return " ".join(words)


def _sentence_windows(sentence: str) -> tuple[str, ...]:
    words = clean(sentence).strip(" >*-\"'()[]").split()
    if len(words) <= _WORDS + 2:
        return (" ".join(words),) if words else ()
    return tuple(" ".join(words[k : k + _WORDS]) for k in range(0, max(1, len(words) - _STEP), _STEP))


_seen_sentence = lru_cache(maxsize=100_000)(_sentence_windows)


def windows(text: str | None) -> list[str]:
    """Sentences of the whole text; long ones as overlapping runs of words. Blank text has none."""
    out: dict[str, None] = {}
    for sentence in _SENTENCE.split(text or ""):
        out.update(dict.fromkeys(_seen_sentence(sentence) if len(sentence) < 300 else _sentence_windows(sentence)))
    return list(out)


def _trainer(content: bytes, most: int = 1 << 16) -> bytes:
    """What zstandard's training gives for the texts of a content: magic, id, entropy tables and the segments it chose."""
    texts = [t for t in content.split(b"\n") if t]
    # Training wants several times as many samples as the dictionary has bytes; repeated ones change no proportion.
    repeats = max(4, -(-40_000 // max(len(content), 1)))
    return zstandard.train_dictionary(max(2048, min(len(content), most)), texts * repeats, k=256, d=8).as_bytes()


#: The repeat offsets every trained dictionary has between its tables and its content.
_REPEATS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


def trained(content: bytes) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on a content's lines, completed with the whole content.

    Training keeps only the segments most lines share, so the rare sentences that matter here are lost (figures in
    the README); its entropy tables are kept, and the content in place of the segments, as zstandard's own
    finishing of dictionaries does. What zstandard cannot train on (a line or two) is used as it is.
    """
    try:
        made = _trainer(content)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    head = made.index(_REPEATS) + len(_REPEATS)
    # The repeat offsets reach eight bytes back, which have to be there.
    return zstandard.ZstdCompressionDict(made[:head] + content.rjust(8, b"\n"), dict_type=zstandard.DICT_TYPE_FULLDICT)


class _Cost:
    """Bytes of a window under the best of some dictionaries, frame overhead taken off. ``contents``: their lines."""

    def __init__(self, contents: list[bytes]):
        self._compress = [self._compressor(trained(c)) for c in contents]

    @staticmethod
    def _compressor(dictionary: zstandard.ZstdCompressionDict):
        how = zstandard.ZstdCompressionParameters.from_level(
            _LEVEL, source_size=_TYPICAL, dict_size=len(dictionary.as_bytes()), write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=how).compress

    def of(self, raw: bytes) -> int:
        if len(self._compress) == 1:
            return len(self._compress[0](raw)) - _OVERHEAD
        return min([len(c(raw)) for c in self._compress]) - _OVERHEAD

    def __call__(self, window: str) -> int:
        return self.of(window.encode())


def _size(window: str) -> int:
    return max(len(window), _SHORTEST)


def _content(texts: Iterable[str], most: int = 1 << 20) -> list[bytes]:
    """All texts as contents of at most ``most`` bytes, the first texts of each last, where matches are cheapest."""
    parts, total = [[]], 0
    for t in texts:
        b = t.encode()
        total += len(b) + 1
        if total > most and parts[-1]:
            parts.append([])
            total = len(b) + 1
        parts[-1].append(b)
    return [b"\n".join(reversed(p)) for p in parts]


class ContentModel:
    """Contents of the dictionaries, and thresholds. Pickles as bytes; dictionaries are trained where it is used, alike everywhere."""

    def __init__(self, ordinary: list[bytes], categories: dict[str, list[bytes]], thresholds: dict[str, float]):
        self.ordinary, self.categories, self.thresholds = ordinary, categories, thresholds
        self._made = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def _costs(self):
        """Of ordinary text, of toxic text (all categories), and of each category; one nothing is known of has no dictionary and saves nothing."""
        if self._made is None:
            known = {k: v for k, v in self.categories.items() if any(v)}
            toxic = _content(line for v in known.values() for part in v for line in part.decode().split("\n"))
            self._made = _Cost(self.ordinary), _Cost(toxic), {k: _Cost(v) for k, v in known.items()}
        return self._made

    def window_score(self, window: str, least: float | None = None) -> dict[str, float]:
        """What toxic text saves against ordinary text, in bytes a character, for the category or categories that cost least.

        It is no more than the category's own dictionary saves. With ``least``, windows for which toxic text saves less
        are not asked of the categories: their scores, all below ``least``, are left out.
        """
        ordinary, toxic, categories = self._made or self._costs()
        raw, size = window.encode(), _size(window)
        base = ordinary.of(raw)
        if not categories or (least is not None and base - 5 < least * size and base - _least_cost(window) < least * size):
            return {}
        saved = base - toxic.of(raw)
        if least is not None and saved < least * size:
            return {}
        costs = [(c.of(raw), k) for k, c in categories.items()]
        best = min(costs)[0]
        return {k: min(saved, base - best) / size for c, k in costs if c == best}

    def scores(self, text: str | None, of=None) -> dict[str, float]:
        """Per category the score of the document's best window, 0 at least."""
        return self.best_of(windows(text), of)

    def best_of(self, texts: Iterable[str], of=None) -> dict[str, float]:
        out = dict.fromkeys(CATEGORIES, 0.0)
        for w in texts:
            for k, v in (of or self.window_score)(w).items():
                out[k] = max(out[k], v)
        return out


@lru_cache(maxsize=300_000)
def _words(window: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[^\W\d_]+", window))


@lru_cache(maxsize=300_000)
def _phrases(window: str) -> frozenset[tuple[str, ...]]:
    """Three words in a row each."""
    w = _words(window)
    return frozenset(zip(w, w[1:], w[2:]))


def _attribute(found: dict[tuple[str, int], set[str]], start: dict[str, list[str]], passes: int = 4) -> dict[tuple[str, int], str]:
    """The category of each window to learn from: what the labels of other documents with its words say.

    A document with several kinds of content is often labelled with one, and some labels are wrong; words
    and word pairs that other documents share outvote a window's own document.
    """
    features = {x: set(w := _words(x[0])) | set(zip(w, w[1:])) for x in found}
    now = {x: (next(iter(labels)) if len(labels) == 1 else None) for x, labels in found.items()}
    for _ in range(passes):
        count: dict[str, Counter] = {k: Counter() for k in CATEGORIES}
        for k, texts in start.items():
            for t in texts:
                for f in set(w := _words(t)) | set(zip(w, w[1:])):
                    count[k][f] += 3
        own: dict[int, dict[str, Counter]] = {}
        for (w, i), k in now.items():
            for c in [k] if k else sorted(found[(w, i)]):
                count[c].update(features[(w, i)])
                own.setdefault(i, {c: Counter() for c in CATEGORIES})[c].update(features[(w, i)])
        then = {}
        for (w, i), labels in found.items():
            votes = dict.fromkeys(CATEGORIES, 0.0)
            for f in features[(w, i)]:
                n = {k: count[k][f] - own[i][k][f] for k in CATEGORIES}
                total = sum(n.values())
                if total > 0:
                    for k in CATEGORIES:
                        votes[k] += math.log((n[k] + 0.3) / (total + 0.9)) * min(1.0, total / 3)
            then[(w, i)] = max(CATEGORIES, key=lambda k: (votes[k] + (3.0 if k in labels else 0.0), k))
        if then == now:
            break
        now = then
    return now


def _train(rows: list[tuple[int, list[str], set[str]]], seeds: dict[str, str]) -> ContentModel:
    """rows: id, windows, labels. Uncalibrated."""
    none = [r for r in rows if r[2] == {"none"}]
    flagged_rows = [r for r in rows if r[2] and "none" not in r[2]]
    given = {k: [s.strip() for s in re.split(r"(?<=[.])\s|\n", seeds.get(k, "")) if s.strip()] for k in (*CATEGORIES, "none")}

    def telltale_of(parts: Callable[[str], Iterable]) -> tuple[set, Counter]:
        """What is in four flagged documents at least and six times as often there as in ordinary ones, and in how many of these each is."""
        bad, good = (Counter(x for _, ws, _ in some for x in {x for w in ws for x in parts(w)}) for some in (flagged_rows, none))
        return {x for x, n in bad.items() if n >= 4 and n / len(flagged_rows) > 6 * (good[x] + 0.5) / (len(none) + 1)}, good

    telltale, seen = telltale_of(_words)
    odd, _ = telltale_of(_phrases)
    frequency = Counter(w for _, ws, _ in none for w in ws)
    # A flagged document passed as ordinary by mistake would hide its wording: what mostly consists of telltale phrases is not ordinary.
    for w in [w for w, n in frequency.items() if n <= 2 + len(none) // 500 and 2 * len(_phrases(w) & odd) > len(_phrases(w))]:
        del frequency[w]
    rare = max(1, len(none) // 700)
    frequency.update({t: 3 for t in given["none"]})
    seen.update(x for t in given["none"] for x in set(_words(t)) for _ in range(rare + 1))
    telling = lambda w: {x for x in _words(w) if len(x) > 2 and (x in telltale or seen[x] <= rare)}
    contents = lambda texts: _content(sorted(texts, key=lambda w: (-frequency[w], w)))
    start = {k: given[k] for k in CATEGORIES}
    told = [(w, i, labels) for i, ws, labels in flagged_rows for w in ws if telling(w)]

    def learn(ordinary: list[bytes]) -> dict[str, list[bytes]]:
        cost = _Cost(ordinary)
        found = {(w, i): labels for w, i, labels in told if cost(w) > 0.45 * _size(w)}
        now = _attribute(found, start)
        return {k: _content(start[k] + sorted({w for (w, _), c in now.items() if c == k})) for k in CATEGORIES}

    content = learn(contents(frequency))
    # Some documents passed as ordinary are not: what the other half of them compresses far worse than a category does is left out.
    suspect = set()
    for half in (0, 1):
        others = ContentModel(contents({w for n, (_, ws, _) in enumerate(none) if n % 2 != half for w in ws}), content, {})
        for n, (_, ws, _) in enumerate(none):
            if n % 2 == half:
                suspect |= {w for w in ws if frequency[w] <= 2 + len(none) // 500 and max(others.window_score(w, 0.25).values(), default=0.0) > 0.25}
    ordinary = contents(frequency.keys() - suspect)
    return ContentModel(ordinary, learn(ordinary), {})


#: Where a threshold lies before any review, and how many flagged reviews weigh as much as that.
USUAL_THRESHOLD, PRIOR_REVIEWS = 0.12, 20


def _best_threshold(scored: list[tuple[float, bool]]) -> float:
    """The threshold from 0.06 to 0.24 of the best F1, drawn towards the usual one the more, the fewer reviews name the category."""
    total = sum(y for _, y in scored)

    def worth(t: float) -> float:
        hit = [y for v, y in scored if v >= t]
        f1 = 2 * sum(hit) / max(1, len(hit) + total)
        return total * f1 - PRIOR_REVIEWS * abs(t - USUAL_THRESHOLD)

    return max((x / 100 for x in range(6, 25)), key=lambda t: (worth(t), -abs(t - USUAL_THRESHOLD)))


def fit(reviewed: list[tuple[int, str, set[str]]], seeds: dict[str, str] | None = None, folds: int = 2) -> ContentModel:
    """reviewed: doc_id, text, the categories reviewers named.

    ``seeds``: sentences of a category (or of ``none``) to start from where there are few reviews; without both nothing is flagged.
    """
    seeds = seeds or {}
    rows = [(i, windows(t), labels) for i, t, labels in sorted(reviewed, key=lambda r: r[0])]
    model = _train(rows, seeds)
    held: dict[str, list[tuple[float, bool]]] = {k: [] for k in CATEGORIES}
    for fold in range(folds):
        part = _train([r for n, r in enumerate(rows) if n % folds != fold], seeds)
        for n, (_, ws, labels) in enumerate(rows):
            if n % folds == fold and labels and not ("none" in labels and len(labels) > 1):
                out = part.best_of(ws, lru_cache(maxsize=None)(partial(part.window_score, least=0.06)))
                for k in CATEGORIES:
                    held[k].append((out[k], k in labels))
    model.thresholds = {k: _best_threshold(held[k]) for k in CATEGORIES}
    return model


def fit_reviews(
    documents: DataFrame, reviews: DataFrame, max_reviewed: int = MAX_REVIEWED, max_chars: int = MAX_REVIEWED_CHARS, seeds: dict[str, str] | None = None
) -> ContentModel:
    """Fits on at most ``max_reviewed`` reviewed documents with at most ``max_chars`` characters in all."""
    labels = (
        reviews.where("doc_id is not null and category is not null")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.lower(F.trim("category")))).alias("labels"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_reviewed)
    )
    # The labels are bounded by max_reviewed, so they travel to the texts and not the other way round.
    texts = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(labels), "doc_id").dropDuplicates(["doc_id"])
    texts = stored(texts.withColumn("order", F.xxhash64("doc_id")), "reviewed-texts")
    sized = texts.select("order", "doc_id", F.length("text").alias("chars")).orderBy("order", "doc_id").collect()  # max_reviewed at most
    taken, chars = [], 0
    for r in sized:
        if chars + r.chars > max_chars:
            break
        chars += r.chars
        taken.append(r.order)
    rows = texts.where(F.col("order") <= taken[-1]).collect() if taken else []
    return fit([(r.doc_id, r.text, set(r.labels) & {*CATEGORIES, "none"}) for r in rows], seeds)


def score_documents(documents: DataFrame, model: ContentModel, below: bool = True) -> DataFrame:
    """doc_id, source and per category a score and a flag (``is_<category>``), one row per document. Without ``below``
    windows that cannot reach the lowest threshold are not asked of the categories and score 0; the flags are the same.

    Defined results: NULL, blank and very short texts score 0; very long ones are read whole, window by
    window; copies score alike; repeated rows each give a row; an empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by max_reviewed and max_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        of = lru_cache(maxsize=200_000)(partial(m.window_score, least=None if below else min(m.thresholds.values())))
        for b in batches:
            scored = [m.scores(t, of) for t in b.column("text").to_pylist()]
            columns = {"doc_id": b.column("doc_id"), "source": b.column("source")}
            for k in CATEGORIES:
                columns[k] = pa.array([s[k] for s in scored], pa.float64())
                columns[f"is_{k}"] = pa.array([s[k] >= m.thresholds[k] for s in scored], pa.bool_())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, source string, " + ", ".join(f"{k} double, is_{k} boolean" for k in CATEGORIES)
    return spread(documents.select("doc_id", "source", "text")).mapInArrow(run, schema)


def flagged(scored: DataFrame) -> DataFrame:
    """doc_id and category of the documents over a threshold."""
    pairs = F.array_compact(F.array(*[F.when(F.col(f"is_{k}"), F.lit(k)) for k in CATEGORIES]))
    return scored.select("doc_id", F.explode(pairs).alias("category"))


def plain_source(source: Column) -> Column:
    """One spelling of a source; NULL for blank ones."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(source)), r"[\s\-]+", "_"), F.lit(""))


def source_rates(scored: DataFrame) -> DataFrame:
    """Per source: documents, and the share of each category and of any."""
    some = F.col("is_abusive") | F.col("is_hateful") | F.col("is_sexual")
    return scored.groupBy(plain_source(F.col("source")).alias("source")).agg(
        F.count("*").alias("documents"),
        *[F.avg(F.col(f"is_{k}").cast("int")).alias(f"{k}_rate") for k in CATEGORIES],
        F.avg(some.cast("int")).alias("any_rate"),
    )
