"""Languages of documents and of their passages, by compression.

Every language has a raw-content zstandard dictionary of labelled text. A sentence is encoded with each of them and
belongs to the language whose code is smallest; where the smallest codes are nearly as large as each other (digits,
sequence letters, random strings) it is rejected and belongs to none. Over the sentences of a document the sum of code
sizes is minimised with a price for every change of language, so that a name or a short quotation does not cut a passage.

The dictionaries come from a bounded sample: at most DOCS_PER_LANGUAGE hand-checked documents and SAMPLE_BYTES of text
a language, of which a dictionary holds DICTIONARY_BYTES. A language with less than LEAST_BYTES of hand-checked text
takes delivered labels instead, without sentences that another language's dictionary knows. All documents are
classified, whole.

Defined results: null, empty and wordless texts have no language and no passage; a document delivered twice is one;
a document of any length is cut into sentences (of at most UNIT letters), so its time grows with its length only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread, table

DOCS_PER_LANGUAGE = 500
#: text of a language's sample, of which no document makes up more than an eighth
SAMPLE_BYTES = 200_000
DICTIONARY_BYTES = 40_000
LEAST_BYTES = 4_000
LEVEL = 1
#: level for a text without one clear sentence: short, so its shortest matches count
CLOSE_LEVEL = 19
UNIT = 400
#: a sentence whose two smallest codes differ by less than this share is of no language
NARROW = 0.03
#: price in bytes of a change of language between two sentences
SWITCH = 14
#: letters of sentences in a row that make another language one of the text's
LEAST_RUN = 300

_SENTENCE = re.compile(r"[^\r\n.!?。！？]+[.!?。！？]*[\"'”»」]*")
_OTHER = re.compile(r"[\W\d_]+")
_BYTE_OF = {bytes([b]).decode("cp1252", "ignore") or chr(b): b for b in range(128, 256)}
_DAMAGED = re.compile("[" + re.escape("".join(_BYTE_OF) + "".join(map(chr, range(128, 160)))) + "]{2,}")


def repaired(text: str) -> str:
    """Text with UTF-8 that was read as a one-byte charset put right, where its bytes are valid UTF-8."""

    def put_right(m: re.Match) -> str:
        try:
            return bytes(_BYTE_OF.get(c, ord(c)) for c in m.group()).decode("utf-8")
        except ValueError:
            return m.group()

    return _DAMAGED.sub(put_right, text)


def sentences(text: str) -> list[tuple[int, int]]:
    """Places of the sentences; a stretch without ends is cut at blanks, and where it has none, by length."""
    out = []
    for m in _SENTENCE.finditer(text):
        a, b = m.span()
        while b - a > UNIT:
            cut = text.rfind(" ", a + UNIT // 2, a + UNIT)
            cut = cut if cut > 0 else a + UNIT
            out.append((a, cut))
            a = cut
        out.append((a, b))
    return out


def words_only(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).strip().encode()


class Model:
    """Dictionaries by language; holds plain bytes, so it travels with a task."""

    def __init__(self, texts: dict[str, bytes]):
        self.langs = sorted(k for k, v in texts.items() if v)
        self.texts = {k: texts[k] for k in self.langs}
        self._encoders: dict[int, list] = {}
        self._known: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"langs": self.langs, "texts": self.texts, "_encoders": {}, "_known": {}}

    def _encode(self, unit: bytes, level: int) -> tuple[int, ...]:
        if level not in self._encoders:
            import zstandard

            self._encoders[level] = []
            for k in self.langs:
                held = zstandard.ZstdCompressionDict(self.texts[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=level)
                self._encoders[level].append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return tuple(len(e(unit)) for e in self._encoders[level])

    def sizes(self, unit: bytes) -> tuple[int, ...]:
        """Code size of a unit under each language."""
        if unit not in self._known:
            if len(self._known) > 20_000:  # menus and notices recur; what else is held is let go
                self._known.clear()
            self._known[unit] = self._encode(unit, LEVEL)
        return self._known[unit]

    def passages(self, text: str | None) -> list[tuple[int, int, str | None, float, int]]:
        """(start, end, language or None, confidence, letters of its sentences) of the text, repaired, in order.

        Confidence is the share by which the smallest code is below the next language's. Sentences of no language
        between two passages belong to neither.
        """
        units, sizes, words = [], [], []
        fixed = repaired(text) if text else ""
        for a, b in sentences(fixed):
            unit = words_only(fixed[a:b])
            if unit:
                units.append((a, b))
                words.append(unit)
                sizes.append(self.sizes(unit))
        if not units or len(self.langs) < 2:
            return []
        cost = np.array(sizes, np.float64)
        two = np.partition(cost, 1, axis=1)[:, :2]
        clear = two[:, 1] - two[:, 0] >= NARROW * two[:, 1]
        if not clear.any():  # too little in any one sentence; all of them together may still tell
            close = np.array(self._encode(b" ".join(words), CLOSE_LEVEL), np.float64)
            two = np.partition(close, 1)[:2]
            if two[1] - two[0] >= NARROW * two[1]:
                clear[:] = True
                cost = np.tile(close / len(units), (len(units), 1))
        path = _smoothed(np.where(clear[:, None], cost, 0.0))
        out: list[list] = []
        for i, (a, b) in enumerate(units):
            lang = int(path[i]) if clear[i] else -1
            if out and out[-1][2] == lang:
                out[-1][1], out[-1][4] = b, out[-1][4] + b - a
                out[-1][5] += cost[i]
            elif lang < 0 and out and b - a < LEAST_RUN // 4:
                continue  # a few wordless letters do not end a passage
            else:
                out.append([a, b, lang, 0.0, b - a, cost[i].copy()])
        done = []
        for a, b, lang, _, n, total in out:
            if lang < 0:
                done.append((a, b, None, 0.0, n))
                continue
            rest = np.delete(total, lang).min()
            done.append((a, b, self.langs[lang], round(float(max(0.0, 1 - total[lang] / rest)), 4), n))
        return done


def _smoothed(cost: np.ndarray) -> np.ndarray:
    """Language of each sentence so that code sizes and changes cost least in sum."""
    n, k = cost.shape
    best = cost.argmin(axis=1)
    if n == 1 or (best == best[0]).all():
        return best
    came = np.zeros((n, k), np.int64)
    total = cost[0].copy()
    stay = np.arange(k)
    for i in range(1, n):
        low = int(total.argmin())
        change = total[low] + SWITCH
        came[i] = np.where(total <= change, stay, low)
        total = np.minimum(total, change) + cost[i]
    path = np.empty(n, np.int64)
    path[-1] = int(total.argmin())
    for i in range(n - 1, 0, -1):
        path[i - 1] = came[i, path[i]]
    return path


def languages_of(passages: list[tuple[int, int, str | None, float, int]]) -> list[tuple[str, float]]:
    """(language, confidence): that of most of the text first, then each other with a long enough passage."""
    letters: Counter = Counter()
    longest: Counter = Counter()
    sure: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for _, _, lang, confidence, n in passages:
        if lang is not None:
            letters[lang] += n
            longest[lang] = max(longest[lang], n)
            sure[lang].append((n, confidence))
    if not letters:
        return []
    main = min(letters, key=lambda k: (-letters[k], k))
    langs = [main, *sorted(k for k in letters if k != main and longest[k] >= LEAST_RUN)]
    return [(k, round(sum(n * c for n, c in sure[k]) / sum(n for n, _ in sure[k]), 4)) for k in langs]


def label_language(label: Column, languages: DataFrame) -> Column:
    """lang of a delivered label in any notation, else null. languages is a fixed list of a few rows."""
    names = {n.lower(): r["lang"] for r in languages.collect() for n in (r["lang"], r["lang3"], r["lang_name"]) if n}
    pairs = F.create_map(*(F.lit(x) for kv in sorted(names.items()) for x in kv))
    return F.try_element_at(pairs, F.regexp_replace(F.lower(label), r"[-_].*$", ""))


def _sample(labels: DataFrame, documents: DataFrame) -> dict[str, list[str]]:
    """Texts of at most DOCS_PER_LANGUAGE documents and SAMPLE_BYTES of each language; bounded, so they go to the driver."""
    by = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    few = labels.filter("lang is not null").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= DOCS_PER_LANGUAGE).select("doc_id", F.col("lang").alias("known"), "rank")
    texts = documents.select("doc_id", F.substring("text", 1, SAMPLE_BYTES // 32).alias("text")).filter("text <> ''")  # a letter has up to four bytes
    held = texts.join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id"])
    total = F.sum(F.octet_length("text")).over(Window.partitionBy("known").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    rows = held.withColumn("total", total).filter(F.col("total") <= SAMPLE_BYTES).select("doc_id", "known", "text").collect()
    out: dict[str, list[str]] = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        out[r["known"]].append(r["text"])
    return out


def train(labels: DataFrame, documents: DataFrame, languages: DataFrame) -> Model:
    """Dictionaries from hand-checked labels, and from delivered ones for a language that has too few of these."""
    hand = _sample(labels.select("doc_id", label_language(F.col("lang"), languages).alias("lang")), documents)
    units = {k: [[u for a, b in sentences(fixed) if (u := words_only(fixed[a:b]))] for t in texts for fixed in (repaired(t),)] for k, texts in hand.items()}
    texts = _dictionaries(units)
    wanted = [r["lang"] for r in languages.collect()]
    scarce = [k for k in wanted if len(texts.get(k, b"")) < LEAST_BYTES]
    if scarce:
        said = documents.select("doc_id", label_language(F.col("lang"), languages).alias("lang"))
        more = _sample(said.filter(F.col("lang").isin(scarce)), documents)
        known = Model({k: v for k, v in texts.items() if k not in scarce})
        for k, found in more.items():
            for t in found:
                fixed = repaired(t)
                doc = [u for a, b in sentences(fixed) if len(u := words_only(fixed[a:b])) > 20]
                units.setdefault(k, []).append([u for u in doc if not known.langs or min(known.sizes(u)) > 0.7 * len(u)])
        texts = _dictionaries(units)
    return Model(texts)


def _dictionaries(units: dict[str, list[list[bytes]]]) -> dict[str, bytes]:
    """A dictionary of each language from the sentences of its documents.

    Menus and notices in another language stand in many documents. A sentence is left out where its words occur in
    clearly more of another language's documents than in the other documents of its own.
    """
    seen = {k: Counter(w for doc in docs for w in {w for u in doc for w in _words(u)}) for k, docs in units.items()}
    out = {}
    langs = [k for k in units if units[k]]
    size = np.log([len(units[k]) + 1 for k in langs])
    for k, docs in units.items():
        own = np.array([y == k for y in langs], np.float64)
        share: dict[str, np.ndarray] = {}
        kept: Counter = Counter()
        verdict: dict[bytes, bool] = {}
        for doc in docs:
            for u in dict.fromkeys(doc):
                if u not in verdict:
                    words = _words(u)
                    for w in words:
                        if w not in share:
                            share[w] = np.log(np.array([seen[y][w] for y in langs]) - own + 0.05) - size
                    mean = sum(share[w] for w in words) / max(1, len(words))
                    verdict[u] = bool(words) and not _random(u) and mean[own > 0].max() + 0.5 >= mean.max()
                kept[u] += verdict[u]
        kept = +kept
        # what brings a word that is not held twice yet goes first, so that rare notices are not crowded out
        held: Counter = Counter()
        first, rest = [], []
        for u in sorted(kept, key=lambda u: (-kept[u], u)):
            new = any(held[w] < 2 for w in _words(u))
            (first if new else rest).append(u)
            held.update(_words(u) if new else ())
        parts, size = [], 0
        for u in (*first, *rest):
            if size + len(u) < DICTIONARY_BYTES:
                parts.append(u)
                size += len(u) + 1
        out[k] = b" ".join(parts)
    return out


def _random(unit: bytes) -> bool:
    """Sequence letters, encoded bytes and the like: words far longer or shorter than a language's."""
    words = unit.split()
    return unit.isascii() and (max(map(len, words)) >= 30 or (len(words) >= 8 and len(unit) < 3 * len(words)))


def _words(unit: bytes) -> list[str]:
    """Words of a sentence, or pairs of characters where it has no blanks."""
    text = unit.decode()
    return [p for w in text.split() for p in ([w] if len(w) < 12 or w.isascii() else [w[i : i + 2] for i in range(len(w) - 1)])]


def _classified(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(d, n, *p[:4]) for d, t in zip(doc, text) for n, p in enumerate(model.passages(t))]
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "passage", "start", "end", "lang", "confidence"])

    return run


def _languages(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, label, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = languages_of(model.passages(t))
                rows += [(d, label, lang, i == 0, len(found), sure) for i, (lang, sure) in enumerate(found)]
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "label", "lang", "main", "n_langs", "confidence"])

    return run


def _spread(documents: DataFrame) -> DataFrame:
    """Documents over tasks by number: encoding takes far longer than moving them, and files may be few or uneven."""
    return documents.repartition(2 * spread(documents.sparkSession))


def document_languages(documents: DataFrame, labels: DataFrame, languages: DataFrame) -> DataFrame:
    """(doc_id, label, lang, main, n_langs, confidence): a row for each language of each document; label is the delivered one in the form of languages.lang, or null."""
    model = train(labels, documents, languages)
    said = label_language(F.col("lang"), languages)
    rows = _spread(documents.select("doc_id", said.alias("label"), "text")).mapInArrow(_languages(model), "doc_id bigint, label string, lang string, main boolean, n_langs int, confidence double")
    return rows.distinct()


def passage_languages(documents: DataFrame, labels: DataFrame, languages: DataFrame) -> DataFrame:
    """(doc_id, passage, start, end, lang, confidence): the passages of each text in order; lang is null for wordless ones."""
    model = train(labels, documents, languages)
    return _spread(documents.select("doc_id", "text")).mapInArrow(_classified(model), "doc_id bigint, passage int, start int, end int, lang string, confidence double").distinct()


def wrong_labels(found: DataFrame) -> DataFrame:
    """(doc_id, lang) of document_languages' rows whose label is missing or not the main language, or with several languages."""
    main = F.max(F.when(F.col("main"), F.col("lang"))).over(Window.partitionBy("doc_id"))
    return found.withColumn("is", main).filter(F.col("label").isNull() | (F.col("label") != F.col("is")) | (F.col("n_langs") > 1)).select("doc_id", "lang")


def _tables(spark, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, folder, "documents").select("doc_id", "text", "lang"), table(spark, folder, "lang_labels"), table(spark, folder, "languages")


def p9_found(spark, folder: str) -> DataFrame:
    return wrong_labels(document_languages(*_tables(spark, folder)))


def p9_passages(spark, folder: str) -> DataFrame:
    return passage_languages(*_tables(spark, folder))
