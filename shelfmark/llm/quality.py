"""Quality by the perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Trusted texts are those labelled good and not toxic. By a hash of the text, three quarters train the model and the rest is
held out to set thresholds (copies of a text are on one side). Words (runs of other bytes than the six ASCII spaces, after
lower-casing A-Z) that trusted texts have twice or more are the vocabulary, each language's its own; if they are more than
``vocabulary`` (a million), the rarest counts are left out. Other words fall into four classes by the symbols they hold.

1. *Counts.* Trigrams ``u v w`` of the training texts are counted per task, dealt into shards by their middle word, and
   merged there. With all of ``v`` in one shard, the counts of ``u v w``, the totals of contexts ``u v``, the number of
   ``u`` before each ``v w``, and the totals of contexts ``v`` are all at hand in it. Counts of counts give the discounts of
   each language and order; the number of ``v`` before each ``w`` is summed over the shards.
2. *Join.* Each document's distinct trigrams are shuffled to the same shards (a group of documents at a time: each trigram
   once, with the documents that have it and how often), looked up, and scored. What goes back is one sum per document
   and shard.
3. *Threshold.* The mean log probability of a text is compared with its language's, in units of the deviation that a text of
   its length has. The threshold is the ``quantile`` of that score over the language's held-out trusted texts: text below it
   is too hard to foresee to be prose of the language. Low perplexity is no reason to reject: training texts and copies of
   them have it too.

Only the vocabulary with its unigram probabilities (12 bytes a word, at most ``vocabulary`` words) is broadcast; trigram
counts and the documents' trigrams are only shuffled. A word that is very frequent as ``v`` is one shard's, but only its
distinct trigrams are, once for each group of documents; they are read as a stream against that shard's counts.

A null or empty text has no perplexity and is not kept. A text of a language (or a null language) without trusted texts on
both sides cannot be judged and is kept. Null or repeated ``doc_id``: each row is judged by itself. Empty tables: nothing is
trusted, so nothing is judged. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import words
from shelfmark.llm.blocks import deltas, packed, unpacked
from shelfmark.llm.common import discard, partitions, read, text_key, tidy, without, written

VOCABULARY, QUANTILE, HELD_OUT = 1 << 20, 0.005, 4
#: Bytes that are neither letters nor digits nor spaces.
_SYMBOLS = words.BLACK & ~words.ALNUM
_CLASSES = 4
#: Words of texts whose trigrams are asked for together: a trigram of several of them is sent once.
_ASKED_TOGETHER = 1_300_000
#: Bits of a word's number, trigrams that a task counts at once, trusted ids up to which they are broadcast.
_BITS, _AT_ONCE, _SMALL_IDS = 21, 3_000_000, 4_000_000
_WORD = (1 << _BITS) - 1


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the documents labelled good and not toxic."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def _rows(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``doc_id, key, lang, text, side``: 1 trains the model, 2 is held out, 0 is not trusted."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    ids = trusted.select(F.col("doc_id").alias("__trusted"))
    if ids.count() <= _SMALL_IDS:
        ids = F.broadcast(ids)
    side = F.when(F.col("__trusted").isNull(), 0).when(F.pmod("key", F.lit(HELD_OUT)) == 0, 2).otherwise(1)
    return rows.join(ids, rows.doc_id == F.col("__trusted"), "left").select("doc_id", "key", "lang", "text", side.alias("side"))


# --- vocabulary

def _shape(symbols: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The class of an unknown word: without symbols; with one or two besides letters; with more, or of symbols alone."""
    return np.where(symbols == length, 3, np.minimum(symbols, 3))


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple]:
    """First row, languages and words of groups of a batch's texts."""
    for start in range(0, batch.num_rows, 1000):  # few texts at a time are Python objects
        some = batch.slice(start, 1000)
        langs = np.array(some.column("lang").to_pylist(), object)
        for first, texts in words.groups(some.column("text").to_pylist()):
            yield start + first, langs[first : first + len(texts)], words.hashed(texts, words.BLACK, count=_SYMBOLS)


_WORDS = "shard int, lang string, words binary, counts binary"


def _unigrams(n: int):
    """A task's words with their counts, a block per language and shard."""

    def blocks(held: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        rows = []
        for lang, parts in held.items():
            word, count = np.unique(np.concatenate(parts), return_counts=True)
            shard = (words.mixed(word) % np.uint64(n)).astype(np.int64)
            for own in np.unique(shard).tolist():
                at = shard == own
                rows.append((own, lang, packed(deltas(word[at].astype(np.int64))), packed(count[at])))
        types = (pa.int32(), pa.string(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in _WORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for _, langs, (text, word, _, _) in _grouped(batch):
                for lang in set(langs):
                    held.setdefault(lang, []).append(word[langs[text] == lang] >> np.uint64(1))
                size += len(word)
                if size >= _AT_ONCE:
                    yield blocks(held)
                    held, size = {}, 0
        if held:
            yield blocks(held)

    return run


def _summed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, n`` of the words of count 2 and more, and a row without a word for each language; reads blocks by shard
    and language."""

    def done() -> pa.RecordBatch:
        word, n = _merge(parts)
        word, n = word[n > 1], n[n > 1]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(word) + 1), pa.string()), pa.array([*word.tolist(), None], pa.int64()), pa.array(np.append(n, 0))], names=["lang", "word", "n"]
        )

    shard, lang, parts = None, None, []
    for batch in batches:
        for here, own, word, n in zip(*(batch.column(c) for c in batch.schema.names), strict=True):
            if parts and (here.as_py(), own.as_py()) != (shard, lang):
                yield done()
                parts = []
            shard, lang = here.as_py(), own.as_py()
            parts.append((np.cumsum(unpacked(word.as_py())), unpacked(n.as_py())))
    if parts:
        yield done()


class Vocabulary:
    """Word numbers: each language has the classes of unknown words, the start of a text, and its words, frequent ones first."""

    def __init__(self, words_of: dict[str, np.ndarray]):
        self.words = {lang: w.view(np.uint64) for lang, w in sorted(words_of.items())}
        sizes = np.array([len(w) + _CLASSES + 1 for w in self.words.values()], np.int64)
        #: By language, in order: the first number.
        self.bases, self.size = np.cumsum(sizes) - sizes, int(sizes.sum())
        if self.size > _WORD:
            raise ValueError(f"{self.size} words are more than {_WORD}")
        self.ranks = {lang: np.argsort(w) for lang, w in self.words.items()}
        self.known = {lang: w[self.ranks[lang]] for lang, w in self.words.items()}

    def trigrams(self, langs: np.ndarray, hashed: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """``(text, key)`` of the trigrams of texts in known languages; a key is ``v, u, w`` of 21 bits each."""
        text, word, symbols, length = hashed
        number, start = np.full(len(word), -1, np.int64), np.zeros(len(langs), np.int64)
        for base, (lang, known) in zip(self.bases.tolist(), self.known.items(), strict=True):
            start[langs == lang] = base + _CLASSES
            mine = np.flatnonzero((langs == lang)[text])
            w = word[mine] >> np.uint64(1)
            own = _shape(symbols[mine], length[mine])
            if len(known):
                at = np.minimum(np.searchsorted(known, w), len(known) - 1)
                own = np.where(known[at] == w, self.ranks[lang][at] + _CLASSES + 1, own)
            number[mine] = base + own
        keep = number >= 0
        text, w = text[keep], number[keep]
        first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
        v = np.where(first, start[text], np.concatenate([[0], w[:-1]])) if len(text) else w
        u = np.where(first, start[text], np.concatenate([[0], v[:-1]])) if len(text) else w
        return text, v << 2 * _BITS | u << _BITS | w


def _language(bases: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which language a word's number belongs to."""
    return np.searchsorted(bases, number, side="right") - 1


def known_words(good: DataFrame, vocabulary: int) -> Vocabulary:
    """The vocabulary of the training rows: words of count 2 and more, by falling count as far as all of a count fit."""
    n = partitions(good.sparkSession)
    dealt = good.mapInArrow(tidy(_unigrams(n)), _WORDS).repartition(n, "shard").sortWithinPartitions("shard", "lang")
    counts = written(dealt.mapInArrow(tidy(_summed_words), "lang string, word long, n long"), "words")
    langs = [r["lang"] for r in counts.select("lang").distinct().collect()]
    # words of each count: as many rows as there are different counts below the threshold that matters
    by_count = counts.where("n > 1").groupBy(F.least("n", F.lit(100_000)).alias("n")).count().orderBy(F.desc("n")).collect()
    room, least = vocabulary - len(langs) * (_CLASSES + 1), 1 << 62
    for r in by_count:
        room -= r["count"]
        if room < 0:
            break
        least = r["n"]
    # no more rows than `vocabulary`
    kept = counts.where(F.least("n", F.lit(100_000)) >= max(least, 2)).select("lang", "word", "n").toArrow()
    discard(counts)
    lang, word, n = (kept.column(c).to_numpy() for c in ("lang", "word", "n"))
    order = np.lexsort((word, -n))
    lang, word = lang[order], word[order]
    return Vocabulary({x: word[lang == x] for x in langs})


# --- shards

def _keys_packed(keys: np.ndarray, bases: np.ndarray) -> bytes:
    """Sorted trigrams: ``v`` as differences, ``u`` as differences within a ``v``, ``w`` as it is, both within their language."""
    v, base = keys >> 2 * _BITS, bases[_language(bases, keys >> 2 * _BITS)]
    step, u = deltas(v), (keys >> _BITS & _WORD) - base
    parts = packed(step), packed(np.where(step != 0, u, deltas(u))), packed((keys & _WORD) - base)
    return np.array([len(x) for x in parts], np.int64).tobytes() + b"".join(parts)


def _keys_unpacked(raw: bytes, bases: np.ndarray) -> np.ndarray:
    ends = np.cumsum(np.frombuffer(raw[:24], np.int64)) + 24
    step, u, w = (unpacked(raw[a:b]) for a, b in zip([24, *ends[:-1]], ends, strict=True))
    v = np.cumsum(step)
    base = bases[_language(bases, v)]
    # a running sum that starts anew with each v
    total = np.cumsum(u)
    new = np.flatnonzero(np.append(True, step[1:] != 0)) if len(u) else np.zeros(0, np.int64)
    u = total - np.repeat(total[new] - u[new], np.diff(np.append(new, len(u))))
    return v << 2 * _BITS | (u + base) << _BITS | (w + base)


def _shards(keys: np.ndarray, n: int) -> np.ndarray:
    """The shard of each key, by its middle word."""
    return (words.mixed((keys >> 2 * _BITS).astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def _by_shard(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the places of their keys; sorted keys stay sorted within a shard."""
    shard = _shards(keys, n)
    order = np.argsort(shard, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(shard[order[a]]), order[a:b]


# --- counts

_COUNTS, _ASKED, _KNOWN = 0, 1, 2
_BLOCK = "shard int, kind int, keys binary, counts binary"
_BLOCK_NAMES = ["shard", "kind", "keys", "counts"]


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_BLOCK_NAMES)


def _counted(vocabulary, n: int):
    """Trigrams of a task's texts with their counts, a block per shard."""

    def blocks(held: list[np.ndarray], known: Vocabulary) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return _blocks([(shard, _COUNTS, _keys_packed(keys[at], known.bases), packed(counts[at])) for shard, at in _by_shard(keys, n)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = Vocabulary(vocabulary.value), [], 0
        for batch in batches:
            for _, langs, hashed in _grouped(batch):
                held.append(known.trigrams(langs, hashed)[1])
                size += len(held[-1])
                if size >= _AT_ONCE:
                    yield blocks(held, known)
                    held, size = [], 0
        if size:
            yield blocks(held, known)

    return run


def _merge(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all blocks in order, with the sum of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*blocks, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(counts, new)


def _each_shard(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[tuple[int, list, Iterator]]:
    """Rows sorted by shard and kind: each shard, its rows of the first kinds up to ``kind``, and those after them as a stream."""
    rows = (r for b in batches for r in zip(*(b.column(c) for c in b.schema.names), strict=True))
    row = next(rows, None)
    while row is not None:
        shard, head = row[0].as_py(), []
        while row is not None and row[0].as_py() == shard and row[1].as_py() <= kind:
            head.append(row)
            row = next(rows, None)

        def rest():
            nonlocal row
            while row is not None and row[0].as_py() == shard:  # noqa: B023
                yield row
                row = next(rows, None)

        tail = rest()
        yield shard, head, tail
        for _ in tail:
            pass


def _totals(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values of sorted keys."""
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(values, new) if len(new) else values[:0]


class Counts:
    """A shard's counts: trigrams, contexts ``v u``, continuations ``v w`` and contexts ``v``, each sorted."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bases: np.ndarray):
        self.keys, self.counts = keys, counts
        pair = (keys >> 2 * _BITS) << _BITS | keys & _WORD
        order = np.argsort(pair, kind="stable")
        self.after, self.before = _totals(pair[order], np.ones(len(pair), np.int64))
        # nothing stands before the start: what follows it is counted as it is
        first = np.isin(self.after >> _BITS, bases + _CLASSES)
        if first.any():
            self.before = np.where(first, _totals(pair[order], counts[order])[1], self.before)


def _merged(bases: np.ndarray):
    """Of each shard: the number of ``v`` before each ``w``, and the counts of counts by language and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, head, _ in _each_shard(batches, _COUNTS):
            keys, counts = _merge([(_keys_unpacked(r[2].as_py(), bases), unpacked(r[3].as_py())) for r in head])
            own = Counts(keys, counts, bases)
            word, n = np.unique(own.after & _WORD, return_counts=True)
            yield _blocks([(shard, _ASKED, packed(deltas(word)), packed(n))])
            some = []
            for order, (k, c) in ((3, (keys >> 2 * _BITS, counts)), (2, (own.after >> _BITS, own.before))):
                lang = _language(bases, k)
                low = c <= 4
                some.append(np.stack([np.full(low.sum(), order), lang[low], c[low]], axis=1))
            kinds, n = np.unique(np.concatenate(some), axis=0, return_counts=True)
            yield _blocks([(shard, _KNOWN, packed(kinds.ravel()), packed(n))])

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n``: the number of ``v`` before each ``w``, summed within a task."""
    parts = [(np.cumsum(unpacked(k.as_py())), unpacked(c.as_py())) for b in batches for k, c in zip(b.column("keys"), b.column("counts"), strict=True)]
    if parts:
        word, n = _merge(parts)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], names=["word", "n"])


def discounts(of: dict[int, int]) -> list[float]:
    """The discounts of counts 0, 1, 2, 3+ from the counts of counts; fixed ones where no count is 1."""
    n1, n2, n3, n4 = (of.get(i, 0) for i in (1, 2, 3, 4))
    if not n1:
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5
    # never 0: what was not seen keeps a probability
    return [0.0, *(min(max(x, 0.1), i + 1.0) for i, x in enumerate(d))]


def _discounted(counts: np.ndarray, lang: np.ndarray, by_lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts less their discounts, and the discounts."""
    d = by_lang[lang, np.minimum(counts, 3)]
    return np.maximum(counts - d, 0.0), d


class Model:
    """What all shards need: where languages begin, the words' unigram probabilities, and discounts by language."""

    def __init__(self, bases: np.ndarray, unigram: np.ndarray, bigrams: np.ndarray, trigrams: np.ndarray):
        self.bases, self.unigram, self.bigrams, self.trigrams = bases, unigram, bigrams, trigrams

    def fitted(self, counts: Counts) -> None:
        """Adds to a shard's counts the probabilities' parts that they give."""
        lang = _language(self.bases, counts.keys >> 2 * _BITS)
        kept, d = _discounted(counts.counts, lang, self.trigrams)
        counts.context, total = _totals(counts.keys >> _BITS, counts.counts)
        at = np.searchsorted(counts.context, counts.keys >> _BITS)
        counts.high = kept / total[at]
        counts.high_rest = np.bincount(at, d, len(total)) / total
        lang = _language(self.bases, counts.after >> _BITS)
        kept, d = _discounted(counts.before, lang, self.bigrams)
        counts.middle, total = _totals(counts.after >> _BITS, counts.before)
        at = np.searchsorted(counts.middle, counts.after >> _BITS)
        counts.low = kept / total[at]
        counts.low_rest = np.bincount(at, d, len(total)) / total

    def logs(self, counts: Counts, keys: np.ndarray) -> np.ndarray:
        """Natural logarithms of P(w | u v)."""

        def found(known: np.ndarray, wanted: np.ndarray, values: np.ndarray, other: float) -> np.ndarray:
            if not len(known):
                return np.full(len(wanted), other)
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            return np.where(known[at] == wanted, values[at], other)

        v, w = keys >> 2 * _BITS, keys & _WORD
        low = found(counts.after, v << _BITS | w, counts.low, 0.0) + found(counts.middle, v, counts.low_rest, 1.0) * self.unigram[w]
        high = found(counts.keys, keys, counts.high, 0.0) + found(counts.context, keys >> _BITS, counts.high_rest, 1.0) * low
        return np.log(high)


def train(rows: DataFrame, vocabulary: int = VOCABULARY) -> tuple[Vocabulary, Model, DataFrame, Broadcast]:
    """The vocabulary and model of the rows of side 1, and their trigrams in blocks, which are to be merged by shard: to
    count again takes less than to write the merged counts and shuffle them once more."""
    spark, n = rows.sparkSession, shards(rows.sparkSession)
    good = rows.where("side = 1").select("lang", "text")
    known = known_words(good, vocabulary)
    sent = spark.sparkContext.broadcast(known.words)
    counted = good.mapInArrow(tidy(_counted(sent, n)), _BLOCK)
    dealt = counted.repartition(n, "shard").sortWithinPartitions("shard", "kind")
    tables = written(dealt.mapInArrow(tidy(_merged(known.bases)), _BLOCK), "trigrams")
    before = tables.where(F.col("kind") == _ASKED).select("keys", "counts").mapInArrow(tidy(_exploded), "word long, n long")
    # no more rows than the vocabulary has words
    before = before.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    of: dict[tuple[int, int], dict[int, int]] = {}
    for r in tables.where(F.col("kind") == _KNOWN).select("keys", "counts").collect():  # a few rows of numbers per shard
        for (order, lang, c), m in zip(unpacked(r["keys"]).reshape(-1, 3).tolist(), unpacked(r["counts"]).tolist(), strict=True):
            own = of.setdefault((order, lang), {})
            own[c] = own.get(c, 0) + m
    langs = range(len(known.words))
    bigrams, trigrams = (np.array([discounts(of.get((order, i), {})) for i in langs]).reshape(-1, 4) for order in (2, 3))
    count, unigram = np.zeros(known.size, np.int64), np.zeros(known.size)
    count[before.column("word").to_numpy()] = before.column("n").to_numpy()
    for base, end in zip(known.bases.tolist(), np.append(known.bases, known.size)[1:].tolist(), strict=True):
        predicted = np.delete(np.arange(base, end), _CLASSES)  # all but the start
        own = count[predicted]
        d = np.array(discounts({i: int((own == i).sum()) for i in (1, 2, 3, 4)}))[np.minimum(own, 3)]
        unigram[predicted] = (np.maximum(own - d, 0) + d.sum() / len(own)) / own.sum() if own.sum() else 1 / len(own)
    discard(tables)
    return known, Model(known.bases, unigram, bigrams, trigrams), counted, sent


# --- scores

def shards(spark) -> int:
    """A third of the shuffle's partitions: each sends one sum per document back."""
    return max(1, partitions(spark) // 3)


_ASK = _BLOCK + ", chunk long, docs binary, meta binary"
_ASK_NAMES = [*_BLOCK_NAMES, "chunk", "docs", "meta"]


def _asked(vocabulary, n: int):
    """For each group of texts: a block per shard of the distinct trigrams, which texts have them and how often; and one
    block that says whose texts they are."""

    def asked(known: Vocabulary, whose: pa.RecordBatch, text: np.ndarray, key: np.ndarray, n_words: np.ndarray, chunk: int) -> pa.RecordBatch:
        order = np.lexsort((text, key))
        text, key = text[order], key[order]
        new = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        times = np.diff(np.append(new, len(key)))
        text, key = text[new], key[new]
        held = np.asarray(whose.column("side")) == 2
        rows = []
        for shard, at in _by_shard(key, n):
            own = key[at]
            cut = np.flatnonzero(np.diff(own, prepend=-1))
            of = np.diff(np.append(cut, len(own)))
            # of held-out texts the squares are wanted too
            rows.append((shard, _ASKED, _keys_packed(own[cut], known.bases), packed(of), chunk, packed(text[at] << 1 | held[text[at]]), packed(times[at])))
        columns = [*whose.columns, pa.array(n_words), pa.array(np.bincount(text, minlength=len(n_words)) > 0)]
        about = pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "lang", "side", "n_words", "known"])
        rows.append((chunk % n, _KNOWN, None, None, chunk, None, _ipc(about)))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_ASK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = Vocabulary(vocabulary.value), TaskContext.get().partitionId() << 36
        for batch in batches:
            begin, parts = 0, []
            for first, langs, hashed in _grouped(batch):
                text, key = known.trigrams(langs, hashed)
                parts.append((text + (first - begin), key, np.bincount(hashed[0], minlength=len(langs))))
                end = first + len(langs)
                if sum(len(p[1]) for p in parts) >= _ASKED_TOGETHER or end == batch.num_rows:
                    whose = batch.select(["doc_id", "key", "lang", "side"]).slice(begin, end - begin)
                    yield asked(known, whose, *(np.concatenate(x) for x in zip(*parts, strict=True)), chunk)
                    begin, parts, chunk = end, [], chunk + 1

    return run


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


_SUMS = "chunk long, sums binary, meta binary, squares binary"


def _answered(model):
    """Sums of log probabilities of each group's texts in this shard; sums of squares by the trigrams' language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value)
        for _, head, rest in _each_shard(batches, _COUNTS):
            blocks = [(_keys_unpacked(r[2].as_py(), own.bases), unpacked(r[3].as_py())) for r in head]
            counts = Counts(*(_merge(blocks) if blocks else (np.zeros(0, np.int64),) * 2), own.bases)
            own.fitted(counts)
            out: list[tuple] = []
            for _, kind, keys, of, chunk, docs, meta in rest:
                if kind.as_py() == _KNOWN:
                    out.append((chunk.as_py(), None, meta.as_py(), None))
                else:
                    keys, docs = _keys_unpacked(keys.as_py(), own.bases), unpacked(docs.as_py())
                    logs, times = np.repeat(own.logs(counts, keys), unpacked(of.as_py())), unpacked(meta.as_py())
                    # texts that have no trigram here are left out of the sums
                    some, at = np.unique(docs, return_inverse=True)
                    squares = np.bincount(at, times * logs * logs)[some & 1 == 1]
                    out.append((chunk.as_py(), packed(deltas(some)), np.bincount(at, times * logs).tobytes(), squares.tobytes()))
                if len(out) >= 256:
                    yield _sums(out)
                    out = []
            if out:
                yield _sums(out)

    return run


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["chunk", "sums", "meta", "squares"])


_SCORES = "doc_id long, key long, lang string, side int, n_words long, known boolean, total double, squares double"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (whose texts, sums of each shard) group by group."""

    def done():
        return pa.RecordBatch.from_arrays([*whose.columns, pa.array(total), pa.array(squares)], names=[x.split()[0] for x in _SCORES.split(", ")])

    whose = None
    for batch in batches:
        for sums, meta, square in zip(*(batch.column(c) for c in ("sums", "meta", "squares")), strict=True):
            if not sums.is_valid:
                if whose is not None:
                    yield done()
                whose = pa.ipc.open_stream(meta.as_buffer()).read_next_batch()
                total, squares = np.zeros(len(whose)), np.zeros(len(whose))
            else:
                at = np.cumsum(unpacked(sums.as_py()))
                total[at >> 1] += np.frombuffer(meta.as_buffer(), np.float64)
                squares[at[at & 1 == 1] >> 1] += np.frombuffer(square.as_buffer(), np.float64)
    if whose is not None:
        yield done()


def perplexities(rows: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """``doc_id, key, lang, side, n_words, known, total, squares``: the sums of log probabilities, and of held-out texts also
    those of their squares."""
    spark, n = rows.sparkSession, shards(rows.sparkSession)
    _, model, counts, names = train(rows, vocabulary)
    parts = spark.sparkContext.broadcast((model.bases, model.unigram, model.bigrams, model.trigrams))
    asked = rows.mapInArrow(tidy(_asked(names, n)), _ASK)
    dealt = counts.unionByName(asked, allowMissingColumns=True).repartition(n, "shard").sortWithinPartitions("shard", "kind")
    answers = dealt.mapInArrow(tidy(_answered(parts)), _SUMS).repartition(partitions(spark), "chunk").sortWithinPartitions("chunk", F.col("sums").isNotNull())
    scores = written(answers.mapInArrow(tidy(_scored), _SCORES), "scores")
    for sent in (names, parts):
        sent.destroy()
    return scores


def judge(
    docs: DataFrame, labels: DataFrame, vocabulary: int = VOCABULARY, quantile: float = QUANTILE,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """One row per document: ``doc_id, key, lang, n_words, perplexity, score, low, kept``.

    ``low`` is the ``quantile`` of the scores of the language's held-out trusted texts.
    """
    scored = perplexities(_rows(docs, trusted_ids(labels), id_col, text_col, lang_col), vocabulary)
    good = scored.where("side = 2 AND known")
    means = good.groupBy("lang").agg((F.sum("total") / F.sum("n_words")).alias("mean"), (F.sum("squares") / F.sum("n_words")).alias("square"))
    means = means.select("lang", "mean", (F.col("square") - F.col("mean") ** 2).alias("within"))
    off = F.col("total") / F.col("n_words") - F.col("mean")
    between = good.join(F.broadcast(means), "lang").groupBy("lang").agg(F.greatest(F.avg(off**2 - F.col("within") / F.col("n_words")), F.lit(0.0)).alias("between"))
    score = F.try_divide(off, F.sqrt(F.col("within") / F.col("n_words") + F.col("between")))
    every = scored.join(F.broadcast(means.join(between, "lang")), "lang", "left").withColumn("score", F.when(F.col("known"), score))
    ends = every.where("side = 2").groupBy("lang").agg(F.percentile_approx("score", quantile, 100_000).alias("low"))
    judged = every.join(F.broadcast(ends), "lang", "left")
    unjudged = F.col("mean").isNull()
    enough = F.coalesce(F.col("score") >= F.col("low"), F.lit(True))
    return judged.select(
        "doc_id", "key", "lang", "n_words", F.when(F.col("known"), F.exp(-F.col("total") / F.col("n_words"))).alias("perplexity"),
        "score", "low", ((F.col("n_words") > 0) & (unjudged | enough)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` with all its columns, without the rows that are judged bad."""
    gone = judge(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, **options).where(~F.col("kept"))
    return without(docs, gone, id_col, text_col)


def op2_quality_classifier(spark, sf_dir):
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("key")
