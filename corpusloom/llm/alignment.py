"""Sentences that are translations of each other in bilingual documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.cluster import checkpoint, with_conf

#: Korean particles and verb endings after a stem, English function words, number words.
_PARTICLE = re.compile(r"(?<=[가-힣]{2})(?:으로부터|에게서|이라도|에서는|으로|에게|에서|까지|부터|이란|이라|에는|에도|보다|처럼|마다|란|을|를|이|가|은|는|의|에|와|과|로|도|만)$")
_VERB = re.compile(r"^([가-힣]{2,}?)(?:하[가-힣]*|할|한|함|해[가-힣]*|되[가-힣]*|된[가-힣]*|될|됨)$")
_STOP = frozenset("the a an of to and in for on by with at as that or be is are it this from shall may which who its any no not such than where if when has have been was were".split())
_UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_MONTHS = "january february march april may june july august september october november december".split()
_WORDS = {w: i for i, w in enumerate(_UNITS)} | {w: 20 + 10 * i for i, w in enumerate(_TENS)}
_WORDS |= {f"{t}-{u}": v + i for t, v in list(_WORDS.items())[20:] for i, u in enumerate(_UNITS[1:10], 1)}
_NUMBER_WORD = re.compile(r"\b(" + "|".join(sorted(_WORDS, key=len, reverse=True)) + r")\b(?:\s*\(\d+\))?")
_MONTH = "|".join(_MONTHS)


def _plain(value: float) -> str:
    return f"{value:.4f}".rstrip("0").rstrip(".")
_KO_WORD = re.compile(r"\d[\d,]*(?:\.\d+)?|[A-Za-z]+|[가-힣]+")
_EN_WORD = re.compile(r"\d[\d,]*(?:\.\d+)?|[a-z]+|[가-힣]+")
_KO_DATE = re.compile(r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일")
_KO_AMOUNT = re.compile(r"(?:(\d[\d,.]*)억)?\s*(?:(\d[\d,.]*)만)?\s*(\d[\d,]*)?\s*원")
_EN_DATES = (re.compile(rf"\b({_MONTH}) (\d{{1,2}}), (\d{{4}})"), re.compile(rf"\b(\d{{1,2}}) ({_MONTH}) (\d{{4}})"))
_EN_AMOUNTS = (re.compile(r"(?:krw|₩)\s*(\d[\d,]*(?:\.\d+)?)\s*(billion|million|thousand)?"), re.compile(r"(\d[\d,]*(?:\.\d+)?)\s*(billion|million|thousand)?\s*won\b"))
_EN_SUFFIX = re.compile(r"(?:ations?|ating|ated|ates?|ings?|ies|ied|ed|es|s|e|y)$")
#: Stems of the words seen, a worker's own; cleared when there are very many.
_KNOWN: dict[str, str | None] = {}


def _remembered(word: str, stem: Callable[[str], str | None]) -> str | None:
    if word not in _KNOWN:
        if len(_KNOWN) > 1_000_000:
            _KNOWN.clear()
        _KNOWN[word] = stem(word)
    return _KNOWN[word]


def korean_terms(sentence: str) -> list[str]:
    """Stems and numbers of a Korean sentence; amounts and dates are one number each."""
    terms: list[str] = []

    def amount(m: re.Match) -> str:
        if not any(m.groups()):
            return m.group()
        parts = [float((g or "0").replace(",", "")) for g in m.groups()]
        terms.append("#w" + _plain(parts[0] * 1e8 + parts[1] * 1e4 + parts[2]))
        return " "

    def date(m: re.Match) -> str:
        terms.append("#d" + "-".join(str(int(g)) for g in m.groups()))
        return " "

    text = sentence.replace("제3자", "제삼자")
    if "월" in text:
        text = _KO_DATE.sub(date, text)
    if "원" in text:
        text = _KO_AMOUNT.sub(amount, text)
    if "100분의" in text:
        text = re.sub(r"100분의\s*(\d)", r"\1", text)
    for word in _KO_WORD.findall(text):
        terms.append("#" + _plain(float(word.replace(",", ""))) if word[0].isdigit() else _remembered(word, _korean_stem))
    return terms


def _korean_stem(word: str) -> str:
    stem = _PARTICLE.sub("", word)
    return m.group(1) if (m := _VERB.match(stem)) else stem.lower()


def english_terms(sentence: str) -> list[str]:
    """Stems and numbers of an English sentence; amounts and dates are one number each."""
    terms: list[str] = []

    def amount(m: re.Match) -> str:
        scale = {"billion": 1e9, "million": 1e6, "thousand": 1e3}.get((m.group(2) or "").lower(), 1)
        terms.append("#w" + _plain(float(m.group(1).replace(",", "")) * scale))
        return " "

    def date(year: str, month: str, day: str) -> str:
        terms.append(f"#d{int(year)}-{_MONTHS.index(month) + 1}-{int(day)}")
        return " "

    text = sentence.lower()
    words = _EN_WORD.findall(text)
    spelled = not _WORDS.keys().isdisjoint(words)
    if spelled or any(w[0].isdigit() for w in words):
        if not set(_MONTHS).isdisjoint(words):
            text = _EN_DATES[0].sub(lambda m: date(m.group(3), m.group(1), m.group(2)), text)
            text = _EN_DATES[1].sub(lambda m: date(m.group(3), m.group(2), m.group(1)), text)
        if "krw" in text or "₩" in text:
            text = _EN_AMOUNTS[0].sub(amount, text)
        if "won" in text:
            text = _EN_AMOUNTS[1].sub(amount, text)
        if spelled:
            text = _NUMBER_WORD.sub(lambda m: f" {_WORDS[m.group(1)]} ", text)
        text = re.sub(r"(\d+)/100\b", r"\1", re.sub(r"\b(\d{1,2}):00\b", r"\1", text))
        words = _EN_WORD.findall(text)
    for word in words:
        if word[0].isdigit():
            terms.append("#" + _plain(float(word.rstrip(",").replace(",", ""))))
        elif stem := _remembered(word, _english_stem):
            terms.append(stem)
    return terms


def _english_stem(word: str) -> str | None:
    if word in _STOP or len(word) < 2:
        return None
    return _EN_SUFFIX.sub("", word)[:7] if len(word) > 4 else word


def term_id(term: str) -> int:
    """A term's number, of 32 bits: odd for numbers, even for words. Two words share one with a probability of 2^-31."""
    import xxhash

    code = xxhash.xxh32_intdigest(term)
    return (code | 1 if term[0] == "#" else code & ~1) - (1 << 31)


def with_terms(sentences: DataFrame) -> DataFrame:
    """(``pair``, ``p``, ``en``, ``no``, ``terms``) of (``pair``, ``p``, ``en``, ``no``, ``sentence``): distinct terms by number, ascending."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, int] = {}
        for batch in batches:
            found = []
            for english, text in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                row = set()
                for term in english_terms(text) if english else korean_terms(text):
                    if (number := ids.get(term)) is None:
                        number = ids[term] = term_id(term)
                    row.add(number)
                found.append(sorted(row))
            if len(ids) > 1_000_000:
                ids.clear()
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(pa.int32()))], names=["pair", "p", "en", "no", "terms"])

    return sentences.mapInArrow(cut, "pair string, p long, en boolean, no int, terms array<int>")


#: Kinds of counts: units with a Korean and an English term, with one of them, all units; sentences with a concept, English ones.
JOINT, KO, EN, UNITS, SENTENCES, LINES = range(6)
_COUNTS = "kind int, k int, e int, n long"


class Counter:
    """Counts of the units in which terms occur, of many units at a time; ``rows`` gives and forgets them."""

    def __init__(self, most: int = 2_000):
        self.most, self.ko, self.en, self.sizes = most, [], [], []
        self.extra: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ko: np.ndarray, en: np.ndarray) -> None:
        self.ko.append(ko)
        self.en.append(en)

    @property
    def full(self) -> bool:
        return len(self.ko) >= self.most

    def rows(self) -> pa.RecordBatch:
        def ranks(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            unit = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
            terms, rank = np.unique(np.concatenate([np.empty(0, np.int32), *parts]), return_inverse=True)
            return terms, rank, unit

        (kt, kr, ku), (et, er, eu) = ranks(self.ko), ranks(self.en)
        zero = np.zeros(1, np.int32)
        out = [(KO, kt, np.zeros(len(kt), np.int32), np.bincount(kr, minlength=len(kt))), (EN, np.zeros(len(et), np.int32), et, np.bincount(er, minlength=len(et))), (UNITS, zero, zero, np.array([len(self.ko)]))]
        starts = np.searchsorted(eu, np.arange(len(self.ko) + 1))
        each = np.diff(starts)[ku] if len(ku) else np.empty(0, np.int64)
        pairs = int(each.sum())
        # Few terms that are common are multiplied as matrices, many rare ones listed: whichever is less work.
        if len(kt) * len(et) and len(kt) * len(et) * len(self.ko) < 400 * pairs:
            left, right = np.zeros((len(self.ko), len(kt)), np.float32), np.zeros((len(self.ko), len(et)), np.float32)
            left[ku, kr] = 1
            right[eu, er] = 1
            many = left.T @ right
            a, b = np.nonzero(many)
            out.append((JOINT, kt[a], et[b], many[a, b].astype(np.int64)))
        elif pairs:
            at = np.arange(pairs) - np.repeat(np.cumsum(each) - each, each) + np.repeat(starts[ku], each)
            cell, many = np.unique(np.repeat(kr, each) * len(et) + er[at], return_counts=True)
            out.append((JOINT, kt[cell // len(et)], et[cell % len(et)], many))
        out += self.extra
        self.ko, self.en, self.extra = [], [], []
        kind = np.concatenate([np.full(len(n), kind, np.int32) for kind, _, _, n in out])
        columns = [kind, *(np.concatenate([part[i] for part in out]) for i in (1, 2, 3))]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64 if i == 3 else np.int32)) for i, c in enumerate(columns)], names=["kind", "k", "e", "n"])


def _words(terms: np.ndarray) -> np.ndarray:
    return terms[terms & 1 == 0]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over pairs of documents, of (``p``, ``en``, ``terms``) in order of ``p``. Only the distinct terms of one pair are held."""
    counter, now = Counter(), None
    sides: dict[bool, list[np.ndarray]] = {False: [], True: []}
    concepts: dict[bool, list[np.ndarray]] = {False: [], True: []}
    lines = 0

    def close() -> None:
        if sides[False] and sides[True]:
            counter.add(*(np.unique(_words(np.concatenate(sides[s]))) for s in (False, True)))
            heard = np.concatenate(concepts[False] + concepts[True])
            counter.extra += [(SENTENCES, np.zeros(len(heard), np.int32), heard, np.ones(len(heard), np.int64)), (LINES, np.zeros(1, np.int32), np.zeros(1, np.int32), np.array([lines]))]

    for batch in batches:
        keys, english = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        ends, flat = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False)), batch.column(2).flatten().to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (english[1:] != english[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if b <= a:
                continue
            if keys[a] != now:
                close()
                now, lines = keys[a], 0
                for held in (sides, concepts):
                    held[False], held[True] = [], []
                if counter.full:
                    yield _summed(counter.rows())
            side = bool(english[a])
            terms = flat[ends[a - 1] if a else 0 : ends[b - 1]]
            sides[side].append(np.unique(terms))
            concepts[side].append(terms if side else terms[terms & 1 == 1])
            lines += (b - a) * side
            if len(sides[side]) > 64:
                sides[side] = [np.unique(np.concatenate(sides[side]))]
    close()
    yield _summed(counter.rows())


def _summed(rows: pa.RecordBatch) -> pa.RecordBatch:
    table = pa.Table.from_batches([rows]).group_by(["kind", "k", "e"], use_threads=False).aggregate([("n", "sum")])
    return table.select(["kind", "k", "e", "n_sum"]).rename_columns(["kind", "k", "e", "n"]).combine_chunks().to_batches()[0]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over linked sentences, of (Korean terms, English terms)."""
    counter = Counter(20_000)
    for batch in batches:
        sides = []
        for i in (0, 1):
            flat, ends = batch.column(i).flatten().to_numpy(), np.cumsum(batch.column(i).value_lengths().to_numpy(zero_copy_only=False))
            sides.append([_words(part) for part in np.split(flat, ends[:-1])])
        for ko, en in zip(*sides, strict=True):
            counter.add(ko, en)
        if counter.full:
            yield counter.rows()
    yield counter.rows()


def associations(counts: DataFrame, least: float) -> DataFrame:
    """(``k``, ``e``, ``phi``): the Korean and English words that share units, by their correlation over all units.

    All partners are kept whose correlation is at least ``least`` and beyond chance.
    """
    first = counts.where(F.col("kind") == UNITS).agg(F.sum("n")).first()[0] or 0
    n = F.lit(float(max(first, 1)))
    nk = counts.where(F.col("kind") == KO).select("k", F.col("n").alias("nk"))
    ne = counts.where(F.col("kind") == EN).select("e", F.col("n").alias("ne"))
    both = counts.where((F.col("kind") == JOINT) & (F.col("n") > 1)).select("k", "e", "n").join(nk, "k").join(ne, "e")
    spread = F.sqrt(F.col("nk") * F.col("ne") * (n - F.col("nk") + 1) * (n - F.col("ne") + 1))
    scored = both.withColumn("phi", (n * F.col("n") - F.col("nk") * F.col("ne")) / spread)
    return scored.where(F.col("phi") > F.greatest(F.lit(least), 3.0 / F.sqrt(n))).select("k", "e", "phi")


def projection(counts: DataFrame, related: DataFrame) -> DataFrame:
    """(``en``, ``term``, ``dim``, ``value``): what each term adds to which concepts, an English term or a number each.

    ``counts`` holds in how many sentences every concept occurs, of how many English ones. Concepts add
    their weight to themselves; Korean words add the similarities of ``related``, scaled to one a term,
    by weight.
    """
    many = (counts.where(F.col("kind") == LINES).agg(F.sum("n")).first()[0] or 0) + 1
    heard = counts.where(F.col("kind") == SENTENCES)
    weights = heard.select(F.col("e").alias("term"), F.greatest(F.lit(0.3), F.log(F.lit(float(many)) / F.col("n"))).alias("w"))
    number = F.col("term").bitwiseAND(F.lit(1)) == 1
    own = weights.select(F.lit(True).alias("en"), "term", F.col("term").alias("dim"), F.col("w").alias("value"))
    numbers = weights.where(number).select(F.lit(False).alias("en"), "term", F.col("term").alias("dim"), F.col("w").alias("value"))
    norms = related.groupBy("k").agg(F.sqrt(F.sum(F.col("phi") * F.col("phi"))).alias("norm"))
    learned = related.join(norms, "k").join(weights.withColumnRenamed("term", "e"), "e")
    return own.unionByName(numbers).unionByName(learned.select(F.lit(False).alias("en"), F.col("k").alias("term"), F.col("e").alias("dim"), (F.col("phi") / F.col("norm") * F.col("w")).alias("value")))


class Concepts:
    """The rows of ``projection`` for one language, by term."""

    def __init__(self, terms: np.ndarray, dims: np.ndarray, values: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.dims, self.values = dims[order].astype(np.int32), values[order].astype(np.float64)
        self.terms, self.first, self.many = np.unique(terms[order], return_index=True, return_counts=True)

    def entries(self, rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(self.terms):
            return rows[:0], terms[:0], np.empty(0)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        rows, at = rows[known], at[known]
        each = self.many[at]
        where = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(self.first[at], each)
        return np.repeat(rows, each), self.dims[where], self.values[where]


def _vectors(rows: np.ndarray, dims: np.ndarray, values: np.ndarray, followers: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, dimensions and values of ``most`` sparse vectors, in order, and the squared norms of each alone and
    merged with its followers (row numbers, -1 for none; nan from there on)."""
    keys, inverse = np.unique((rows.astype(np.int64) << 32) | (dims.astype(np.int64) + (1 << 31)), return_inverse=True)
    sums = np.bincount(inverse, weights=values, minlength=len(keys))
    begins = np.searchsorted(keys, np.arange(most + 1, dtype=np.int64) << 32)

    def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Products of vectors a and b, row by row."""
        each = begins[a + 1] - begins[a]
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begins[a], each)
        wanted = (keys[at] & 0xFFFFFFFF) | np.repeat(b.astype(np.int64) << 32, each)
        found = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        product = np.where(keys[found] == wanted, sums[at] * sums[found], 0.0) if len(keys) else np.zeros(0)
        return np.bincount(np.repeat(np.arange(len(a)), each), weights=product, minlength=len(a))

    square = np.bincount(keys >> 32, weights=sums * sums, minlength=most)[:most]
    norms = np.full((most, len(followers) + 1), np.nan)
    norms[:, 0] = square
    chain = [np.arange(most), *followers]
    for w in range(1, len(chain)):
        whole = np.flatnonzero(np.logical_and.reduce([c >= 0 for c in chain[: w + 1]]))
        norms[whole, w] = norms[whole, w - 1] + square[chain[w][whole]] + 2 * sum(inner(chain[v][whole], chain[w][whole]) for v in range(w))
    return keys >> 32, (keys & 0xFFFFFFFF) - (1 << 31), sums, norms


_VECTOR = "p long, en boolean, no int, dims array<int>, weights array<float>, norms array<double>"


def _vector_rows(concepts: dict[bool, Concepts] | None, width: int, pairs: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors of sentences in order of (``p``, ``en``, ``no``), given their terms or, without ``concepts``, their
    parts: dimensions and values.

    With ``pairs``, whole pairs of documents are taken at a time, and what cannot meet is left out after the
    norms are known: dimensions that the other document of the pair has not. Else rows are streamed;
    the last of a batch wait for those that follow them.
    """

    def flat(lists: pa.ListArray, english: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        inside = lists.flatten()
        if concepts is None:
            return rows, inside.field(0).to_numpy(zero_copy_only=False), inside.field(1).to_numpy(zero_copy_only=False)
        terms, side = inside.to_numpy(zero_copy_only=False), english[rows]
        parts = [concepts[s].entries(rows[side == s], terms[side == s]) for s in (False, True)]
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def done(batch: pa.RecordBatch, most: int) -> pa.RecordBatch:
        key, english, no, n = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), batch.num_rows
        index, followers = np.arange(n), []
        for w in range(1, width):
            at = np.minimum(index + w, n - 1)
            followers.append(np.where((index + w < n) & (key[at] == key) & (english[at] == english) & (no[at] == no + w), at, -1))
        rows, dims, values, norms = _vectors(*flat(batch.column(3), english), followers, n)
        if pairs:
            cell = (np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))[rows] << 32) | (dims + (1 << 31))
            met = np.zeros(len(cell), dtype=bool)
            for side in (False, True):
                own = english[rows] == side
                met[own] = np.isin(cell[own], cell[~own])
        else:
            met = rows < most
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[met], minlength=most))]).astype(np.int32))
        squares = norms[:most].reshape(-1)
        columns = [
            *(batch.column(i).slice(0, most) for i in range(3)), pa.ListArray.from_arrays(ends, pa.array(dims[met].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(values[met].astype(np.float32))),
            pa.ListArray.from_arrays(pa.array(np.arange(0, len(squares) + 1, width, dtype=np.int32)), pa.array(squares, mask=np.isnan(squares))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["p", "en", "no", "dims", "weights", "norms"])

    def ready(held: pa.RecordBatch) -> int:
        """How many rows need none of those to come."""
        if held.num_rows < max(width, 2_000):
            return 0
        if not pairs:
            return held.num_rows - width + 1
        key = held.column(0).to_numpy()
        before = np.flatnonzero(key != key[-1])
        return int(before[-1]) + 1 if len(before) else 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 2_000 or pairs and batch.num_rows and held[0].column(0)[0] == batch.column(0)[-1]:
                continue
            whole = pa.concat_batches(held)
            if most := ready(whole):
                yield done(whole.slice(0, most) if pairs else whole, most)
                whole = whole.slice(most)
            held = [whole]
        if held and (whole := pa.concat_batches(held)).num_rows:
            yield done(whole, whole.num_rows)

    return build


def _located(terms: DataFrame, concepts: DataFrame, max_broadcast: int, at_home: bool, width: int) -> DataFrame:
    """The vectors of sentences, partitioned by ``p`` if ``at_home``.

    The concepts go to the workers if they are at most ``max_broadcast``; else sentences and concepts are joined.
    """
    concepts = checkpoint(concepts)
    parts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own, known = terms.select("p", "en", "no", "terms"), None
    if concepts.limit(max_broadcast + 1).count() <= max_broadcast:
        rows = concepts.toArrow()
        columns = [rows.column(c).to_numpy() for c in ("en", "term", "dim", "value")]
        known = {side: Concepts(*(c[columns[0] == side] for c in columns[1:])) for side in (False, True)}
    else:
        summed = own.select("p", "en", "no", F.explode("terms").alias("term")).join(concepts, ["en", "term"]).groupBy("p", "en", "no", "dim").agg(F.sum("value").alias("value"))
        own = summed.groupBy("p", "en", "no").agg(F.collect_list(F.struct("dim", "value")).alias("parts")).repartition(parts, "p").sortWithinPartitions("p", "en", "no")
    vectors = own.mapInArrow(_vector_rows(known, width, at_home), _VECTOR)
    return vectors.repartition(parts, "p") if at_home else vectors


def span_scores(terms: DataFrame, concepts: DataFrame, least: float, silent: float = 0.5, conflict: float = 0.75, width: int = 1, max_broadcast: int = 1_000_000, at_home: bool = True) -> DataFrame:
    """(``pair``, ``p``, ``i0``, ``i1``, ``j0``, ``j1``, ``cosine``, ``score``) of spans: a Korean and an English
    sentence, or one of them with up to ``width`` neighbours of the other language merged.

    The score is the geometric mean of the cosine and the share of the lesser side that the other
    contains, so a sentence that leaves something out still fits. Spans below ``least`` are left out, or
    below ``silent`` where a side has no number, or below ``conflict`` where neither side's numbers
    contain the other's.

    With ``at_home``, all rows of ``p`` are put into one partition, and no join, sum or window after it moves any row.
    """
    located = _located(terms, concepts, max_broadcast, at_home, width)
    parts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = range(width)

    def entries(side: bool, no: str, value: str, name: str) -> DataFrame:
        # The side is told after the exchange, so both sides share it.
        flat = located.select("p", F.col("no").alias(no), "weights", "norms", F.posexplode_outer(F.when(F.col("en") == side, F.col("dims"))).alias("at", "dim")).where(F.col("dim").isNotNull())
        return flat.select("p", no, "dim", F.col("weights")[F.col("at")].alias(value), *[F.col("norms")[w].alias(f"{name}{w}") for w in every])

    # Sparse cosines: sentences of a pair meet where they share a concept.
    met = entries(False, "i", "a", "k").join(entries(True, "j", "b", "e").hint("merge"), ["p", "dim"])
    near = met.groupBy("p", "i", "j").agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("dot"), *[F.max(f"{s}{w}").alias(f"{s}{w}") for s in "ke" for w in every])
    # The neighbours' products: of j + 1 with the same i, of i + 1 with the same j.
    right, below = Window.partitionBy("p", "i").orderBy("j"), Window.partitionBy("p", "j").orderBy("i")
    near = near.withColumn("right0", F.col("dot")).withColumn("below0", F.col("dot"))
    for w in every[1:]:
        near = near.withColumn(f"right{w}", F.col(f"right{w - 1}") + F.when(F.lead("j", w).over(right) == F.col("j") + w, F.lead("dot", w).over(right)))
    for w in every[1:]:
        near = near.withColumn(f"below{w}", F.col(f"below{w - 1}") + F.when(F.lead("i", w).over(below) == F.col("i") + w, F.lead("dot", w).over(below)))

    # By shape: how many neighbours are merged on each side. Most cells fall below the limit in all and are not unfolded.
    shapes = {f"s{n}": s for n, s in enumerate([(0, 0)] + [s for w in every[1:] for s in ((0, w), (w, 0))])}

    def product(more_i: int, more_j: int) -> Column:
        return F.col(f"right{more_j}" if more_j else f"below{more_i}")

    def cosine(more_i: int, more_j: int) -> Column:
        return product(more_i, more_j) / F.sqrt(F.col(f"k{more_i}") * F.col(f"e{more_j}"))

    near = near.withColumns({n: F.sqrt(cosine(i, j) * F.least(F.lit(1.0), product(i, j) / F.least(f"k{i}", f"e{j}"))) for n, (i, j) in shapes.items()})
    near = near.where(F.greatest(*shapes, F.lit(0.0)) >= least)
    spans = [F.when(F.col(n) >= least, F.struct(F.col("i").alias("i0"), (F.col("i") + i).alias("i1"), F.col("j").alias("j0"), (F.col("j") + j).alias("j1"), cosine(i, j).alias("cosine"), F.col(n).alias("score"))) for n, (i, j) in shapes.items()]
    scored = near.select("p", F.explode(F.array(*spans)).alias("s")).where(F.col("s").isNotNull()).select("p", "s.*")

    def numbers(side: bool, no: str, name: str) -> DataFrame:
        own = terms.where(F.col("en") == side).select("p", "pair", F.col("no").alias(no), F.filter("terms", lambda t: t.bitwiseAND(F.lit(1)) == 1).alias("own"))
        if at_home:
            own = own.repartition(parts, "p")
        order = Window.partitionBy("p").orderBy(no)
        gathered = [F.col("own")]
        for w in every[1:]:
            gathered.append(F.array_union(gathered[-1], F.when(F.lead(no, w).over(order) == F.col(no) + w, F.lead("own", w).over(order))))
        return own.select("p", no, *([] if side else ["pair"]), F.array(*gathered).alias(name))

    told = scored.join(numbers(False, "i0", "m").hint("merge"), ["p", "i0"]).join(numbers(True, "j0", "n").hint("merge"), ["p", "j0"])
    told = told.withColumn("m", F.col("m")[F.col("i1") - F.col("i0")]).withColumn("n", F.col("n")[F.col("j1") - F.col("j0")])
    fewer = F.least(F.size("m"), F.size("n"))
    needed = F.when(fewer == 0, silent).when(F.size(F.array_intersect("m", "n")) < fewer, conflict).otherwise(least)
    return told.where(F.col("score") >= needed).select("pair", "p", "i0", "i1", "j0", "j1", "cosine", "score")


_SPAN = "pair string, p long, i0 int, i1 int, j0 int, j1 int, cosine double, score double"


def mutual_best(spans: DataFrame, discount: float = 0.03, contained: float = 0.55, sure: bool = False) -> DataFrame:
    """The spans that are best for every sentence in them, then those among what is left, until nothing is;
    at last the single pairs of which one sentence is left and the other, already aligned, contains it.

    This is one pass over the spans of a pair in descending order: a span is taken if none of its
    sentences is. With ``sure``, only if none of them was in a better one, taken or not, and nothing comes
    later. Merged spans pay ``discount`` for each sentence more, so they win only where it adds something.
    Ties go to the smaller spans, then to the first. A pair's spans are streamed; its sentences and single
    spans alone are held.
    """
    more = F.col("i1") - F.col("i0") + F.col("j1") - F.col("j0")
    parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spans.repartition(parts, "p").withColumn("value", F.col("score") - discount * more).sortWithinPartitions("p", F.desc("value"), more, "i0", "j0", "pair").drop("value")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ko, en, singles = None, set(), set(), []

        def late() -> list[tuple]:
            """The best single span of every sentence that is left; spans come in descending order."""
            out, seen = {}, set()
            for row in singles:
                _, _, i, _, j, _, cosine, score = row
                for used, mark in ((ko, ("ko", i)), (en, ("en", j))):
                    # The sentence that is left is contained in the other if the score exceeds what its cosine implies.
                    if mark[1] not in used and mark not in seen and score * score / cosine >= contained:
                        seen.add(mark)
                        out[i, j] = row
            return list(out.values())

        for batch in batches:
            chosen = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, p, i0, i1, j0, j1, _, _ = row
                if p != now:
                    chosen += late()
                    now, ko, en, singles = p, set(), set(), []
                i, j = range(i0, i1 + 1), range(j0, j1 + 1)
                free = ko.isdisjoint(i) and en.isdisjoint(j)
                if free:
                    chosen.append(row)
                elif not sure and i0 == i1 and j0 == j1 and not (i0 in ko and j0 in en):
                    singles.append(row)
                if free or sure:
                    ko.update(i)
                    en.update(j)
            yield _span_rows(chosen)
        yield _span_rows(late())

    return ordered.select("pair", "p", "i0", "i1", "j0", "j1", "cosine", "score").mapInArrow(choose, _SPAN)


def _span_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.int32()] * 4, *[pa.float64()] * 2]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pair", "p", "i0", "i1", "j0", "j1", "cosine", "score"])


def align(sentences: DataFrame, least: float = 0.4, width: int = 3, whole: int = 100_000, max_broadcast: int = 1_000_000) -> DataFrame:
    """(``pair``, ``i0``, ``i1``, ``j0``, ``j1``, ``cosine``, ``score``): aligned spans of Korean and English sentences.

    ``sentences`` has ``pair`` (what the two documents share), ``side`` (``ko`` or ``en``), ``no`` and
    ``sentence``; other columns are not read. Rows with a null among these, sentences without terms and
    documents without a twin are not aligned. Repeated rows are one; of several sentences with one number
    the least by terms counts. No rows: no spans. A sentence is aligned with up to ``width`` neighbours of
    the other language.

    The concepts are learned from all documents: first from words that share paired documents, then
    from words that share the sentences that these concepts align with certainty. Counts and relations
    are tables; concepts of more than ``max_broadcast`` rows stay one.

    Sentences are partitioned by pair, and every later step keeps them there. Pairs of more than
    ``whole`` sentences are not kept in one task: their joins, sums and windows are distributed by all of
    their keys.
    """
    spark = sentences.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = sentences.where(F.col("pair").isNotNull() & F.col("no").isNotNull() & F.col("sentence").isNotNull() & F.col("side").isin("ko", "en"))
    rows = known.select("pair", F.xxhash64("pair").alias("p"), (F.col("side") == "en").alias("en"), F.col("no").cast("int").alias("no"), "sentence")
    # Joins of rows that lie with their pair need no exchange, whichever other keys they have.
    with with_conf(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        once = with_terms(rows).where(F.size("terms") > 0).repartition(parts, "p").groupBy("p", "pair", "en", "no").agg(F.min("terms").alias("terms"))
        terms = checkpoint(once.sortWithinPartitions("p", "en", "no"))
        # The checkpoint keeps partitions and their order.
        counts = checkpoint(terms.select("p", "en", "terms").mapInArrow(_documents, _COUNTS).groupBy("kind", "k", "e").agg(F.sum("n").alias("n")))
        huge = checkpoint(terms.groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") > whole).select("p"))
        groups = [(terms, True)]
        if not huge.isEmpty():
            groups = [(terms.join(huge, "p", "left_anti"), True), (terms.join(huge, "p", "left_semi"), False)]

        def best(concepts: DataFrame, floor: float, sure: bool, wide: int) -> DataFrame:
            found = [span_scores(part, concepts, floor, width=wide, max_broadcast=max_broadcast, at_home=home) for part, home in groups]
            return checkpoint(mutual_best(reduce(DataFrame.unionByName, found), sure=sure))

        links = best(projection(counts, associations(counts, 0.15)), 0.45, True, 1).select("p", F.col("i0").alias("i"), F.col("j0").alias("j"))
        side = lambda en, no, name: terms.where(F.col("en") == en).select("p", F.col("no").alias(no), F.col("terms").alias(name))
        units = links.join(side(False, "i", "ko"), ["p", "i"]).join(side(True, "j", "words"), ["p", "j"]).select("ko", "words")
        fine = units.mapInArrow(_linked, _COUNTS).groupBy("kind", "k", "e").agg(F.sum("n").alias("n"))
        return best(projection(counts, associations(checkpoint(fine), 0.1)), least, False, width).drop("p")


def twin_sentences(sentences: DataFrame) -> DataFrame:
    """(``pair``, ``side``, ``no``, ``sentence``) of the documents that exist in both languages.

    The English twin of a document has its id and ``-en``; ``pair`` is the Korean id.
    """
    key = F.trim(F.col("id"))
    side: Column = F.when(key.endswith("-en"), "en").otherwise("ko")
    return sentences.select(F.regexp_replace(key, "-en$", "").alias("pair"), side.alias("side"), F.col("sentence_no").alias("no"), "sentence")


def sentence_pairs(spans: DataFrame) -> DataFrame:
    """(``ko_id``, ``ko_sentence_no``, ``en_id``, ``en_sentence_no``): a row for each pair within the spans."""
    ko = F.explode(F.sequence("i0", "i1"))
    en = F.explode(F.sequence("j0", "j1"))
    return (
        spans.withColumn("ko_sentence_no", ko)
        .withColumn("en_sentence_no", en)
        .select(F.col("pair").alias("ko_id"), "ko_sentence_no", F.concat("pair", F.lit("-en")).alias("en_id"), "en_sentence_no")
        .distinct()
    )
