"""Quality rules: plain counts and a perplexity band for each language.

The perplexity comes from an interpolated modified Kneser-Ney model over the
bytes of words, of order ``ORDER``, with a mark before and behind each word. Spark
counts every n-gram of every text; the table of distinct n-grams is estimated once
and sent to the tasks as sorted hash arrays: the n-gram's packed bytes are its hash,
so entries never collide, and a binary search finds them. Of more than ``MOST_GRAMS``
n-grams only the most frequent are sent; Spark estimates them all by joins, and the
rest meet the texts that have them in a join too, so none is left out. Each language
has n-grams of its own, told apart by 16 bits of the language's hash.

A document is rejected if its mean log perplexity lies outside its language's
band: the quartiles of all documents that pass the plain rules, widened by
``SPREAD`` times the distance between them, and by a share of it that falls with
the document's length, since short texts scatter more.

Words are runs of other than space, tab, line feed, vertical tab, form feed and
carriage return. A null text counts as empty and, like any with fewer than ten
words, fails the plain rules. A null language is a language of its own. Repeated
rows are counted and judged one by one. An empty table gives no rows. Texts are
read whole; a very long one is worked on alone. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

ORDER = 4
# N-grams sent to each task at most; beyond, the rarest are joined.
MOST_GRAMS = 1 << 23
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
# How far the band reaches beyond the quartiles, in distances between them.
SPREAD = 8.0
# Words at which that distance is taken twice.
SHORT_WORDS = 60.0
SLICE = 4 << 20

OPEN, CLOSE = 256, 257
SYMBOL_BITS = 9
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTED = "gram long, n long"
MEASURED = """doc_id long, lang string, _judged long, n_words long, word_chars long, n_symbols long,
    n_dup_lines long, n_repeat_words long, symbols long, log_prob double, _row long, _rest array<long>"""


def language_code(lang: pa.Array) -> np.ndarray:
    """16 bits for each language; 0 only for null."""
    names, code = lang.dictionary_encode(), {}
    for name in names.dictionary.to_pylist():
        at = np.frombuffer((name or "").encode(), dtype=np.uint8)
        sums = T.Texts(0, 1, at, np.array([0, len(at)])).prefix_hashes()
        h = int(T.span_hashes(sums, np.array([0]), np.array([len(at)]))[0])
        code[name] = h % 65535 + 1
    table = np.array([code[x] for x in names.dictionary.to_pylist()] + [0], dtype=np.uint64)
    return table[names.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)]


@dataclass
class WordGrams:
    """For each symbol of some words the packed n-grams that end with it.

    ``grams[n - 1]`` is valid where ``reach >= n``: n symbols, the opening mark
    among them, lie between the word's begin and the symbol. Packed: the
    language, the order, then the symbols, the last one lowest.
    """

    first: np.ndarray
    reach: np.ndarray
    grams: list[np.ndarray]


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray) -> WordGrams:
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], lengths + 1)
    where = np.repeat(starts, lengths + 1) + at
    closing = at == np.repeat(lengths, lengths + 1)
    symbol = data[np.minimum(where, max(len(data) - 1, 0))].astype(np.uint64)
    symbol[closing] = CLOSE
    code = np.repeat(lang, lengths + 1) << np.uint64(48)
    grams, packed = [], np.zeros(len(symbol), dtype=np.uint64)
    for n in range(1, ORDER + 1):
        back = np.full(len(symbol), OPEN, dtype=np.uint64)
        if n == 1:
            back = symbol
        else:
            back[n - 1 :] = symbol[: len(symbol) - n + 1]
            back[at < n - 1] = OPEN
        packed = packed | (back << np.uint64(SYMBOL_BITS * (n - 1)))
        grams.append(packed | code | np.uint64(n << 45))
    return WordGrams(first, np.minimum(at + 2, ORDER), grams)


def _distinct(texts: T.Texts, words: T.Words, lang: np.ndarray):
    """Distinct words by language: one place, how often, and for each word which."""
    codes = lang[words.text_of()]
    hashes = T.word_hashes(texts, words) ^ T.mix(codes)
    _, at, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    return at, inverse, counts, codes[at]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest n-gram at each symbol with its count, summed over a task's slices."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([c for _, c in held])).astype(np.int64)

    for batch in batches:
        codes = language_code(batch.column(2))
        for texts in T.slices(batch.column(1), SLICE):
            words = T.split_words(texts)
            if not len(words.starts):
                continue
            at, _, counts, lang = _distinct(texts, words, codes[texts.low : texts.high])
            made = word_grams(texts.data, words.starts[at], words.ends[at], lang)
            longest = np.choose(made.reach - 1, made.grams)
            weights = np.repeat(counts, np.diff(made.first))
            keys, where = np.unique(longest, return_inverse=True)
            held.append((keys, np.bincount(where, weights).astype(np.int64)))
            if len(held) > 8:
                held = [merged()]
    if held:
        keys, counts = merged()
        for low in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[low : low + 100_000].view(np.int64)), pa.array(counts[low : low + 100_000])],
                names=["gram", "n"],
            )


@dataclass
class Model:
    """Sorted hash arrays of n-grams with log probability and log back-off weight."""

    keys: np.ndarray
    log_prob: np.ndarray
    log_backoff: np.ndarray

    def _find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return at, self.keys[at] == wanted

    def longest(self, made: WordGrams) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of each symbol by its longest n-gram, 0 where that is not held; which are."""
        wanted = np.choose(made.reach - 1, made.grams)
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), dtype=bool)
        at, known = self._find(wanted)
        return np.where(known, self.log_prob[at], 0.0).astype(np.float64), known

    def score(self, made: WordGrams) -> np.ndarray:
        """Natural log probability of each symbol, by the longest n-gram known."""
        total = np.zeros(len(made.reach))
        open_ = np.arange(len(made.reach))
        for n in range(ORDER, 0, -1):
            able = open_[made.reach[open_] >= n]
            at, known = self._find(made.grams[n - 1][able])
            total[able[known]] += self.log_prob[at[known]]
            missed = able[~known]
            at, known = self._find(shorter(made.grams[n - 1][missed], n))
            total[missed[known]] += self.log_backoff[at[known]]
            if n == 1:
                total[missed] += UNSEEN
            open_ = np.concatenate([open_[made.reach[open_] < n], missed])
        return total


# Log probability of a byte never seen: one of the 257 symbols.
UNSEEN = -np.log(257.0)
_LOW = np.uint64((1 << 45) - 1)
_LANGUAGE = np.uint64(0xFFFF << 48)


def shorter(grams: np.ndarray, n: int) -> np.ndarray:
    """The context of n-grams: without the last symbol."""
    return (grams & _LANGUAGE) | np.uint64((n - 1) << 45) | ((grams & _LOW) >> np.uint64(SYMBOL_BITS))


def later(grams: np.ndarray, n: int) -> np.ndarray:
    """N-grams without the first symbol."""
    kept = np.uint64((1 << SYMBOL_BITS * (n - 1)) - 1)
    return (grams & _LANGUAGE) | np.uint64((n - 1) << 45) | (grams & kept)


def order_of(grams: np.ndarray) -> np.ndarray:
    return ((grams >> np.uint64(45)) & np.uint64(7)).astype(int)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    return _discounts([int((counts == i).sum()) for i in range(1, 5)])


def _discounts(found: list[int]) -> np.ndarray:
    """The same from how many n-grams have the counts 1 to 4."""
    n = [max(x, 1) for x in found]
    y = n[0] / (n[0] + 2 * n[1])
    cut = [0.0] + [(i + 1) - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return np.clip(cut, 0.0, [0.0, 1.0, 2.0, 3.0])


def estimate(grams: np.ndarray, counts: np.ndarray) -> Model:
    """The model of the longest n-grams' counts.

    Below the highest order an n-gram counts as often as different symbols stand
    before it; one that begins with the opening mark has none, so it keeps its
    own count.
    """
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    orders = order_of(grams)
    for n in range(ORDER, 0, -1):
        own, held = grams[orders == n], counts[orders == n]
        if n < ORDER:
            above = later(tables[n + 1][0], n + 1)
            left, seen = np.unique(above, return_counts=True)
            own, at = np.unique(np.concatenate([own, left]), return_inverse=True)
            held = np.bincount(at, np.concatenate([held, seen])).astype(np.int64)
        order = np.argsort(own)
        tables[n] = own[order], held[order]
    keys, probs, backs = [], [], []
    lower_keys, lower_probs = None, None
    for n in range(1, ORDER + 1):
        own, held = tables[n]
        if not len(own):
            continue
        cut = discounts(held)[np.minimum(held, 3)]
        contexts, at = np.unique(shorter(own, n), return_inverse=True)
        totals = np.bincount(at, held)
        weights = np.bincount(at, cut) / totals
        if n == 1:
            below = np.full(len(own), 1 / 257.0)
        else:
            below = lower_probs[np.searchsorted(lower_keys, later(own, n))]
        prob = (held - cut) / totals[at] + weights[at] * below
        lower_keys, lower_probs = own, prob
        keys.append(own)
        probs.append(np.log(prob))
        backs.append((contexts, np.log(np.maximum(weights, 1e-30))))
    known, log_prob = np.concatenate(keys), np.concatenate(probs)
    # A context of an opening mark alone is no n-gram with a probability of its own.
    contexts = np.concatenate([c for c, _ in backs])
    every = np.unique(np.concatenate([known, contexts]))
    log_probs = np.full(len(every), -np.inf, dtype=np.float32)
    log_backs = np.zeros(len(every), dtype=np.float32)
    log_probs[np.searchsorted(every, known)] = log_prob
    log_backs[np.searchsorted(every, contexts)] = np.concatenate([w for _, w in backs])
    return Model(every, log_probs, log_backs)


def _context(gram: Column, n: int) -> Column:
    """``shorter`` as a column."""
    begin = gram.bitwiseAND(F.lit(-1 << 48)).bitwiseOR(F.lit((n - 1) << 45))
    return begin.bitwiseOR(F.shiftright(gram.bitwiseAND(F.lit((1 << 45) - 1)), SYMBOL_BITS))


def _suffix(gram: Column, n: int) -> Column:
    """``later`` as a column."""
    begin = gram.bitwiseAND(F.lit(-1 << 48)).bitwiseOR(F.lit((n - 1) << 45))
    return begin.bitwiseOR(gram.bitwiseAND(F.lit((1 << SYMBOL_BITS * (n - 1)) - 1)))


def estimate_all(table: DataFrame) -> DataFrame:
    """``gram, n, log_prob`` of each counted n-gram: ``estimate`` by joins, for any number of them.

    A text scored under the model it was counted for has no n-gram that the model lacks,
    so no back-off weights are needed.
    """
    order = F.shiftright("gram", 45).bitwiseAND(F.lit(7))
    tables: dict[int, DataFrame] = {}
    for n in range(ORDER, 0, -1):
        own = table.where(order == n)
        if n < ORDER:
            left = tables[n + 1].groupBy(_suffix(F.col("gram"), n + 1).alias("gram")).agg(F.count("*").alias("n"))
            own = own.unionByName(left).groupBy("gram").agg(F.sum("n").alias("n"))
        tables[n] = materialise(own, f"grams{n}")
    found, below = [], None
    for n in range(1, ORDER + 1):
        seen = dict(tables[n].where("n <= 4").groupBy("n").count().collect())
        cuts = _discounts([seen.get(i, 0) for i in range(1, 5)]).tolist()
        cut = F.element_at(F.array(*[F.lit(c) for c in cuts]), (F.least("n", F.lit(3)) + 1).cast("int"))
        every = tables[n].select("gram", "n", cut.alias("cut"), _context(F.col("gram"), n).alias("context"))
        contexts = every.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight"))
        every = every.join(contexts, "context")
        if below is None:
            every = every.withColumn("below", F.lit(1 / 257.0))
        else:
            every = every.withColumn("suffix", _suffix(F.col("gram"), n)).join(below, "suffix")
        prob = (F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("below")
        made = materialise(every.select("gram", prob.alias("prob")), f"probabilities{n}")
        below = made.select(F.col("gram").alias("suffix"), F.col("prob").alias("below"))
        found.append(table.where(order == n).join(made, "gram"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select("gram", "n", F.ln("prob").cast("float").alias("log_prob"))


def _least_count(table: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` n-grams reach it."""
    rows = table.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count("*").alias("c")).collect()
    total, least = 0, 1
    for row in sorted(rows, key=lambda r: -r.p):  # one row for each power of two
        if total + row.c > most:
            return 1 << (row.p + 1)
        total += row.c
    return least


def train(docs: DataFrame, most: int = MOST_GRAMS) -> tuple[Model, DataFrame | None] | None:
    """Count the n-grams of every text and estimate the model; None without words.

    Of more than ``most`` n-grams the model holds the most frequent, and a table has
    ``gram, log_prob`` of all others.
    """
    counted = docs.mapInArrow(_count, COUNTED)
    table = materialise(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    if table.count() <= most:
        rows = table.toArrow()
        if not len(rows):
            return None
        return estimate(rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy()), None
    known = materialise(estimate_all(table), "gram_probabilities")
    least = _least_count(known, most)
    rows = known.where(F.col("n") >= least).select("gram", "log_prob").toArrow()
    keys = rows.column("gram").to_numpy().view(np.uint64)
    at = np.argsort(keys)
    model = Model(keys[at], rows.column("log_prob").to_numpy()[at], np.zeros(len(keys), dtype=np.float32))
    return model, known.where(F.col("n") < least).select("gram", "log_prob")


def _with_rest(measured: DataFrame, rest: DataFrame) -> DataFrame:
    """Add to each row what its n-grams outside the sent model give."""
    missed = measured.select("_row", F.explode("_rest").alias("gram")).join(rest, "gram")
    more = missed.groupBy("_row").agg(F.sum(F.col("log_prob").cast("double")).alias("_more"))
    both = measured.drop("_rest").join(more, "_row", "left")
    return both.withColumn("log_prob", F.col("log_prob") + F.coalesce("_more", F.lit(0.0))).drop("_more")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(texts: T.Texts, words: T.Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each text in windows that it has twice or more."""
    every, first = T.grams(hashes, words, WINDOW)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts).astype(np.uint64)
    _, inverse, seen = np.unique(every ^ T.mix(owner + np.uint64(1)), return_inverse=True, return_counts=True)
    at = np.arange(len(every)) + np.repeat(words.first[:-1] - first[:-1], counts)
    at = at[seen[inverse] > 1]
    edges = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return _sums(np.cumsum(edges[:-1]) > 0, words.first)


def repeated_lines(texts: T.Texts, sums: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier one."""
    n = len(texts.offsets) - 1
    breaks = np.flatnonzero(texts.data == 10)
    # A text without bytes has one line, which holds no word.
    starts = np.concatenate([texts.offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(n), np.searchsorted(texts.offsets, breaks, side="right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.empty(len(starts), dtype=np.int64)
    ends[:-1] = starts[1:] - 1
    last = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(owner) else np.zeros(0, bool)
    ends[last] = texts.offsets[1:][owner[last]]
    filled = np.concatenate([[0], np.cumsum(~T.SPACE[texts.data])])
    held = filled[ends] > filled[starts]
    starts, ends, owner = starts[held], ends[held], owner[held]
    keys = T.span_hashes(sums, starts, ends) ^ T.mix(owner.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(keys, return_index=True)
    return np.bincount(owner, minlength=n) - np.bincount(owner[at], minlength=n)


def _missed(made: WordGrams, known: np.ndarray, inverse: np.ndarray, words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """The longest n-grams not known, as often as each text has them, and where each text's begin."""
    missed = np.flatnonzero(~known)
    grams = np.choose(made.reach - 1, made.grams)[missed]
    first = np.searchsorted(missed, made.first)
    held = np.diff(first)[inverse]
    ends = np.cumsum(held)
    at = np.arange(ends[-1]) + np.repeat(first[:-1][inverse] - (ends - held), held)
    return grams[at], np.concatenate([[0], ends])[words.first]


def _measure(sent):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, made_rows = None, 0
        for batch in batches:
            if model is None and sent is not None:
                model = Model(*sent.value)
            codes = language_code(batch.column(2))
            for texts in T.slices(batch.column(1), SLICE):
                words = T.split_words(texts)
                bounds = texts.offsets
                sums = texts.prefix_hashes()
                hashes = T.span_hashes(sums, words.starts, words.ends)
                inside = ~T.SPACE[texts.data] & ((texts.data & 0xC0) != 0x80)
                log_prob, symbols = np.zeros(len(words.counts)), np.zeros(len(words.counts))
                rest, rests = np.zeros(0, dtype=np.uint64), np.zeros(len(words.counts) + 1, dtype=np.int64)
                if len(words.starts) and model is not None:
                    at, inverse, _, lang = _distinct(texts, words, codes[texts.low : texts.high])
                    made = word_grams(texts.data, words.starts[at], words.ends[at], lang)
                    scores, known = model.longest(made)
                    log_prob = _sums(np.add.reduceat(scores, made.first[:-1])[inverse], words.first)
                    symbols = _sums(np.diff(made.first)[inverse], words.first)
                    if not known.all():
                        rest, rests = _missed(made, known, inverse, words)
                n = texts.high - texts.low
                numbers = np.arange(made_rows, made_rows + n) + (TaskContext.get().partitionId() << 33)
                made_rows += n
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(texts.low, n) for i in (0, 2, 3)],
                        *[
                            pa.array(np.asarray(x, dtype=np.int64))
                            for x in (
                                words.counts, _sums(inside, bounds), _sums(SYMBOLS[texts.data], bounds),
                                repeated_lines(texts, sums), repeated_words(texts, words, hashes), symbols,
                            )
                        ],
                        pa.array(log_prob), pa.array(numbers),
                        pa.ListArray.from_arrays(pa.array(rests, pa.int32()), pa.array(rest.view(np.int64))),
                    ],
                    names=[
                        "doc_id", "lang", "_judged", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "symbols", "log_prob", "_row", "_rest",
                    ],
                )

    return measure


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    spread: float = SPREAD, judged: tuple[str, ...] = (), most: int = MOST_GRAMS,
) -> DataFrame:
    """Counts, ``perplexity`` for each symbol, the language's band, and ``kept`` for each row.

    With ``judged`` a hash of those columns is added as ``_judged``, by which a caller
    finds the row of a verdict even where keys are not unique. ``most`` bounds the n-grams
    that a task holds, and changes no row.
    """
    mark = F.xxhash64(*judged) if judged else F.lit(0).cast("long")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"),
        F.col(lang).cast("string").alias("lang"), mark.alias("_judged"),
    )
    trained = train(rows, most)
    sent = rest = None
    if trained is not None:
        model, rest = trained
        arrays = (model.keys, model.log_prob, model.log_backoff)
        sent = docs.sparkSession.sparkContext.broadcast(arrays)
    measured = materialise(rows.mapInArrow(_measure(sent), MEASURED), "measured")
    if rest is not None:
        measured = materialise(_with_rest(measured, rest), "measured_whole")
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED_PERCENT) * F.col("n_words")
    verdicts = measured.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeated)
    verdicts = verdicts.withColumn(
        "log_perplexity", F.when(F.col("symbols") > 0, -F.col("log_prob") / F.col("symbols"))
    )
    quartiles = F.percentile_approx("log_perplexity", F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    bands = verdicts.where(~F.col("base_failed")).groupBy("lang").agg(quartiles.alias("q"))
    bands = bands.select(
        F.col("lang").alias("_lang"), F.col("q")[0].alias("lower"), F.col("q")[1].alias("upper")
    )
    wide = (F.col("upper") - F.col("lower")) * spread * (1 + F.lit(SHORT_WORDS) / F.greatest("n_words", F.lit(1)))
    inside = F.col("log_perplexity").between(F.col("lower") - wide, F.col("upper") + wide)
    both = verdicts.join(bands, verdicts["lang"].eqNullSafe(bands["_lang"]), "left")
    return both.select(
        F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"), F.col("lang").alias(lang),
        *(["_judged"] if judged else []),
    )
