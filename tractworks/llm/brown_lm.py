"""Brown class-based language model.

Training tokens (words in lower-case A-Z, then one end per text) are counted over all training texts. The ``core`` most
frequent words are put into ``classes`` classes by exchange clustering: word after word moves to the class that raises the
likelihood of the class bigrams most, in sweeps, until nothing moves. What is gathered for that is the core's bigram
table (at most core x core numbers). Then come exchange rounds over all texts: for each other ``held`` word Spark counts the
classes before and after it, and it goes to the class that explains both best. From the second round on all ``held`` words have
classes, so what is counted are the neighbours themselves; rounds end when the likelihood of the class bigrams stops rising. The
words beyond ``held`` take one such step against the final classes. The state h before a token is the class of the last ``held``
word or end before it: of the token next to it, unless that is unseen or beyond ``held``.

    P(w | h) = P(class(w) | h) P(w | class(w))

Transitions are smoothed with the class's overall share; emissions lose a discount of n1 / (n1 + 2 n2) counts (0.75 at most); an unseen
word is one type of a class of its own, whose transition is the Good-Turing share of words seen once after h. The
probabilities of all seen words and the unseen type add up to one for each h.

Texts are scored where they lie with the ``held`` most frequent words, which go to all tasks (a bounded table); the other
words of a text are looked up by a join on the word, however many they are.

Null texts are empty (one end); rows without an id are in the fold of the empty text; repeated rows are scored each;
an empty table gives an empty result; without training texts every token is unseen; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import fold_of, lean, read, row_keys, settle

CORE, CLASSES, HELD = 2000, 64, 300_000
SWEEPS, ROUNDS = 8, 3
#: Tokens that a task looks up together, and rows after which it sends what it has counted.
TOGETHER, FLUSH = 3_000_000, 400_000
END = b""


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens of an array of binary texts, the place of each token in them, text after text, and the number of each text's tokens."""
    text = pc.fill_null(texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    coded = lists.flatten().dictionary_encode()
    names, codes = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
    end = pc.index(names, pa.scalar(END)).as_py()  # white space at either side of a text leaves empty words
    if end < 0:
        end = len(names)
        names = pa.concat_arrays([names, pa.array([END])])
    word = codes != end
    stops = np.concatenate([[0], np.cumsum(word)])[lists.offsets.to_numpy()]
    return names, np.insert(codes[word], stops[1:], end), np.diff(stops) + 1


def split_batches(batches: Iterator[pa.RecordBatch], column: int = 0, most: int = TOGETHER) -> Iterator[list[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]]:
    """Batches and their split texts, about ``most`` tokens at a time."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch, *split_texts(batch.column(column))))
            size += len(held[-1][2])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def places_of(names: list[pa.Array], words: pa.Array) -> list[np.ndarray]:
    """For each array the places of its words in ``words``, -1 for others; one table of ``words`` serves all arrays."""
    at = pc.fill_null(pc.index_in(pa.chunked_array(names), value_set=words), -1).to_numpy()
    return np.split(at, np.cumsum([len(n) for n in names])[:-1])


def merged(counts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Batches of keys and their counts ``n``, equal keys added up."""
    keys = counts[0].schema.names[:-1]
    sums = pa.Table.from_batches(counts).group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return sums.select([*keys, "n_sum"]).rename_columns([*keys, "n"]).to_batches(FLUSH)


def states(core: np.ndarray, start: int) -> np.ndarray:
    """For each place the value of the last place before it with ``core`` >= 0, or ``start``."""
    at = np.maximum.accumulate(np.where(core >= 0, np.arange(len(core)), -1))
    before = np.empty(len(core), np.int64)
    before[:1] = -1
    before[1:] = at[:-1]
    return np.where(before >= 0, core[np.maximum(before, 0)], start)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all tokens of a frame with one binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in split_batches(batches):
            yield from merged([pa.RecordBatch.from_arrays([names, pa.array(np.bincount(codes, minlength=len(names)))], names=["word", "n"]) for _, names, codes, _ in held])

    return texts.mapInArrow(lean(run), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def cut_off(counts: DataFrame, *most: int) -> list[int]:
    """For each bound the least count such that no more words than that have it or a larger one.

    Counts from 256 on are judged by their first eight binary digits, so that a few thousand sums decide, however many words there are.
    """
    digits = F.expr("greatest(length(bin(n)) - 8, 0)")
    step = counts.withColumn("e", digits).select(F.expr("shiftleft(shiftright(n, e), e)").alias("step"))
    sums = sorted(map(tuple, step.groupBy("step").count().collect()), reverse=True)
    out = []
    for bound in most:
        least, words = 2**62, 0
        for value, n in sums:
            words += n
            if words > bound:
                break
            least = value
        out.append(least)
    return out


def encode(texts: DataFrame, words: list[bytes]) -> DataFrame:
    """(ids, rare): blocks of texts as 32-bit places in ``words``, -1 for other words, and these other words in order."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.binary())
        for held in split_batches(batches):
            for (_, names, codes, _), at in zip(held, places_of([names for _, names, _, _ in held], table), strict=True):
                ids = at[codes].astype(np.int32)
                rare = names.take(pa.array(codes[ids < 0]))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), rare), b" ")
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), joined], names=["ids", "rare"])

    return texts.mapInArrow(lean(run), "ids binary, rare binary")


def summed(keys: Iterator[np.ndarray], most: int = 6_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and their counts, about ``most`` at a time."""

    def counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(held)
        held.clear()
        every.sort()
        at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        return every[at], np.diff(np.append(at, len(every)))

    held, size = [], 0
    for key in keys:
        if len(key):
            held.append(key)
            size += len(key)
        if size >= most:
            yield counted(held)
            size = 0
    if held:
        yield counted(held)


def core_bigrams(coded: DataFrame, places: np.ndarray, size: int) -> np.ndarray:
    """size x size counts of a core token and the next one, words between them left out; ``places`` has -1 for other words."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                ids = np.append(places, -1)[np.frombuffer(block, np.int32)]
                ids = np.append(size - 1, ids[ids >= 0])
                yield ids[:-1] * size + ids[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in summed(keys(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])

    found = coded.mapInArrow(lean(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # size x size rows at most
    table = np.zeros(size * size)
    table[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(size, size)


def exchange(table: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """A class for each word of a bigram table; words are taken by falling frequency, the last one (end) stays alone."""

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    words = len(table)
    free = max(1, min(classes - 1, words - 1))
    of = np.arange(words) % free
    of[-1] = free
    k = free + 1
    one = np.zeros((words, k))
    one[np.arange(words), of] = 1
    after = table @ one  # word -> class
    before = table.T @ one  # class -> word, as word x class
    pairs = one.T @ after
    for _ in range(sweeps):
        moved = 0
        for w in range(words - 1):
            old = of[w]
            right, left, loop = after[w].copy(), before[w].copy(), table[w, w]
            right[old] -= loop
            left[old] -= loop
            pairs[old] -= right
            pairs[:, old] -= left
            pairs[old, old] -= loop
            rows, cols = pairs.sum(1), pairs.sum(0)
            n_right, n_left = right.sum() + loop, left.sum() + loop
            diagonal = np.diag(pairs)
            gain = (f(pairs + right) - f(pairs)).sum(1) + (f(pairs + left[:, None]) - f(pairs)).sum(0)
            gain -= f(diagonal + right) + f(diagonal + left) - 2 * f(diagonal)
            gain += f(diagonal + right + left + loop) - f(diagonal)
            gain -= f(rows + n_right) - f(rows) + f(cols + n_left) - f(cols)
            gain[free] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new] += right
            pairs[:, new] += left
            pairs[new, new] += loop
            if new != old:
                moved += 1
                of[w] = new
                after[:, old] -= table[:, w]
                after[:, new] += table[:, w]
                before[:, old] -= table[w]
                before[:, new] += table[w]
        if not moved:
            break
    return of


def around(ids: np.ndarray, history: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The states before the places of a block, and the classes after them; ``history`` has -1 for words that are passed over."""
    own = history[ids]
    return states(own, start), states(own[::-1], start)[::-1]


def class_pairs(coded: DataFrame, of: np.ndarray, history: np.ndarray, k: int) -> np.ndarray:
    """k x k counts of a state and the class of the next token that has one."""
    own, history = np.append(of, -1), np.append(history, -1)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                ids = np.frombuffer(block, np.int32)
                c = own[ids]
                yield (states(history[ids], own[-2]) * k + c)[c >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(k * k, np.int64)
        for key in keys(batches):
            pairs += np.bincount(key, minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(pairs)], names=["key", "n"])

    pairs = np.zeros(k * k)
    for key, n in coded.mapInArrow(lean(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n")).collect():  # k x k rows
        pairs[key] = n
    return pairs.reshape(k, k)


def gains_of(pairs: np.ndarray, end: int) -> np.ndarray:
    """2 k x k: what a class before (then after) a word adds to the likelihood if the word is in each class."""
    k = len(pairs)
    share = (pairs.sum(0) + 1) / (pairs.sum() + k)
    move = np.log((pairs + 20 * share) / (pairs.sum(1, keepdims=True) + 20))
    gains = np.concatenate([move - np.log(pairs.sum(0) + 1), move.T])
    gains[:, end] = -np.inf
    return gains


def best_classes(sizes: np.ndarray, h: np.ndarray, n: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """The best class of each word; word after word has ``sizes`` entries of h (k and over: classes after it) and n."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    best = np.empty(len(sizes), np.int32)
    for i in range(0, len(sizes), 20_000):
        a, b = np.searchsorted(row, (i, i + 20_000))
        some = min(20_000, len(sizes) - i)
        cells = (row[a:b] - i) * len(gains) + h[a:b]
        seen = np.bincount(cells, n[a:b], some * len(gains)).reshape(some, -1)  # a state may be listed twice
        value = np.zeros((len(seen), gains.shape[1]))
        for state in range(len(gains)):
            hit = seen[:, state] > 0
            value[hit] += seen[hit, state, None] * gains[state]
        best[i : i + 20_000] = np.argmax(value, axis=1)
    return best


def entries(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, h and n of lists of structs."""
    flat = lists.flatten()
    return np.diff(lists.offsets.to_numpy()), flat.field("h").to_numpy(zero_copy_only=False), flat.field("n").to_numpy(zero_copy_only=False)


def state_lists(seen: DataFrame, key: str, parts: int = 16) -> DataFrame:
    """(key, states): summed counts by state; a frequent word's counts are added up in ``parts`` places before they meet in one row."""
    dealt = seen.withColumn("part", F.pmod("h", F.lit(parts))).repartition(key, "part")
    sums = dealt.groupBy(key, "part", "h").agg(F.sum("n").alias("n")).groupBy(key, "part").agg(F.collect_list(F.struct("h", "n")).alias("some"))
    return sums.groupBy(key).agg(F.flatten(F.collect_list("some")).alias("states"))


def exchange_round(coded: DataFrame, of: np.ndarray, history: np.ndarray, moving: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """``of`` after one step of all ``moving`` words at once, by the classes before and after all their tokens."""
    k = gains.shape[1]
    moves, past, start = np.append(moving, False), np.append(history, -1), int(of[-1])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                ids = np.frombuffer(block, np.int32)
                left, right = around(ids, past, start)
                at = np.flatnonzero(moves[ids])
                base = ids[at].astype(np.int64) * (2 * k)
                yield np.concatenate([base + left[at], base + k + right[at]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in summed(keys(batches)):
            yield pa.RecordBatch.from_arrays([pa.array((key // (2 * k)).astype(np.int32)), pa.array((key % (2 * k)).astype(np.int32)), pa.array(n.astype(np.int64))], names=["id", "h", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best_classes(*entries(batch.column(1)), gains))], names=["id", "class"])

    lists = state_lists(coded.mapInArrow(lean(run), "id int, h int, n bigint"), "id")
    found = settle(lists.mapInArrow(choose, "id int, class int")).toArrow()  # a row for each held word at most
    of = of.copy()
    of[found.column("id").to_numpy()] = found.column("class").to_numpy()
    return of


def likelihood(pairs: np.ndarray) -> float:
    f = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
    return f(pairs) - f(pairs.sum(0)) - f(pairs.sum(1))


def cluster(coded: DataFrame, of: np.ndarray, held: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Classes of all words of the table: ``of`` has the core's, -1 for others; ``held`` words become history once they have a class."""
    moving = of < 0
    best, value = of, -np.inf
    for i in range(rounds):
        history = np.where(held, of, -1)
        pairs = class_pairs(coded, of, history, k)
        if i:
            now = likelihood(pairs)
            if now <= value:
                break
            best, value = of, now
        if not moving.any():
            break
        if i < rounds - 1 or rounds == 1:
            of = exchange_round(coded, of, history, moving, gains_of(pairs, int(of[-1])))
            best = of if not i else best
    return best


LEXICON = "word binary, n bigint, class int, states array<struct<h:int,n:bigint>>"


def held_lexicon(coded: DataFrame, words: list[bytes], of: np.ndarray, history: np.ndarray) -> DataFrame:
    """(word, n, class, states) of the words of the table, from the coded texts."""
    k = int(of.max()) + 1
    shared = coded.sparkSession.sparkContext.broadcast(words)
    past, start = np.append(history, -1), int(of[-1])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                ids = np.frombuffer(block, np.int32)
                yield (ids.astype(np.int64) * k + states(past[ids], start))[ids >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in summed(keys(batches)):
            yield pa.RecordBatch.from_arrays([pa.array((key // k).astype(np.int32)), pa.array((key % k).astype(np.int32)), pa.array(n.astype(np.int64))], names=["id", "h", "n"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value, pa.binary())
        for batch in batches:
            sizes, _, n = entries(batch.column(1))
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), n, len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names.take(batch.column(0)), pa.array(total), pa.array(of[batch.column(0).to_numpy()].astype(np.int32)), batch.column(1)], names=["word", "n", "class", "states"])

    return state_lists(coded.mapInArrow(lean(run), "id int, h int, n bigint"), "id").mapInArrow(lean(name), LEXICON)


def rare_lexicon(coded: DataFrame, of: np.ndarray, history: np.ndarray, gains: np.ndarray) -> DataFrame:
    """(word, n, class, states) of the words that are not in the table; each takes the class that its neighbours explain best.

    All of these words are rarer than those of the table, so none is a hot key.
    """
    k = gains.shape[1]
    past, start = np.append(history, -1), int(of[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i, block in enumerate(batch.column(0).to_pylist()):
                ids = np.frombuffer(block, np.int32)
                left, right = around(ids, past, start)
                names, codes, _ = split_texts(batch.column(1).slice(i, 1))
                base, rare = codes[:-1].astype(np.int64) * (2 * k), np.flatnonzero(ids < 0)  # without the end
                for key, n in summed([np.concatenate([base + left[rare], base + k + right[rare]])]):
                    held.append(pa.RecordBatch.from_arrays([names.take(pa.array(key // (2 * k))), pa.array((key % (2 * k)).astype(np.int32)), pa.array(n.astype(np.int64))], names=["word", "h", "n"]))
                    size += len(n)
                if size >= FLUSH:
                    yield from merged(held)
                    held, size = [], 0
        if held:
            yield from merged(held)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes, h, n = entries(lists)
            row = np.repeat(np.arange(len(sizes)), sizes)
            before = h < k
            total = np.bincount(row[before], n[before], len(sizes)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[before], minlength=len(sizes)))]).astype(np.int32)
            left = pa.ListArray.from_arrays(pa.array(ends), lists.flatten().filter(pa.array(before)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), pa.array(best_classes(sizes, h, n, gains)), left], names=["word", "n", "class", "states"])

    seen = coded.mapInArrow(lean(run), "word binary, h int, n bigint").repartition("word")
    return seen.groupBy("word").agg(F.collect_list(F.struct("h", "n")).alias("states")).mapInArrow(lean(choose), LEXICON)


class Model:
    """Log10 transition and emission tables; class ``k`` is the unseen type's."""

    def __init__(self, lex: DataFrame, words: list[bytes], counts: np.ndarray, of: np.ndarray, k: int, start: int):
        self.k, self.words, self.counts, self.of, self.start = k, words, counts, of, start
        one, two, self.total, self.types = (x or 0 for x in lex.agg(F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long")), F.sum("n"), F.count(F.lit(1))).first())
        self.discount = min(one / (one + 2 * two), 0.75) if one else 0.0
        pairs, once = np.zeros((k, k)), np.zeros(k)
        for h, c, n, n1 in lex.select("class", F.col("n").alias("c"), F.explode("states").alias("s")).groupBy("s.h", "class").agg(F.sum("s.n"), F.sum(F.when(F.col("c") == 1, F.col("s.n")).otherwise(0))).collect():  # k x k rows at most
            pairs[h, c] += n
            once[h] += n1
        self.sizes, self.kinds = pairs.sum(0), np.zeros(k)
        for c, n in lex.groupBy("class").count().collect():
            self.kinds[c] = n
        every = max(self.total, 1)
        unseen = (once + 50 * (one + 1) / (every + 1)) / (pairs.sum(1) + 50) if self.total else np.ones(k)
        unseen = np.minimum(unseen, 0.99) if self.total else unseen
        share = self.sizes / every
        with np.errstate(divide="ignore", invalid="ignore"):
            move = (pairs + 50 * share) / (pairs.sum(1, keepdims=True) + 50) * (1 - unseen)[:, None]
            self.move = np.log10(np.concatenate([move, unseen[:, None]], axis=1))
            self.log_size = np.log10(self.sizes - self.discount * self.kinds)
        self.base_total = self.total + 0.5 * (self.types + 1)

    @property
    def classes(self) -> dict[bytes, int]:
        """The words that make states, and their classes."""
        return dict(zip(self.words, self.of.tolist(), strict=True))


def score(docs: DataFrame, lex: DataFrame, model: Model, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` (the row's id first) of each row with n_tokens, n_known, base_score and score.

    The keys travel with a text's own sums, and a row is known by a hash of id and text, so nothing depends on the order of rows
    or on a second reading of them. Repeated rows meet, and each gets the sums of one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [T.StructField(f"__{i}", docs.schema[k].dataType) for i, k in enumerate(keys)]
    sent_schema = T.StructType([*SENT.fields, *carried])

    def ready() -> tuple:
        m = shared.value
        past = np.append(m.of, -1).astype(np.int64)
        with np.errstate(divide="ignore"):
            emit = np.append(np.log10(m.counts - m.discount) - m.log_size[m.of], 0.0)
            base = np.append(np.log10((m.counts + 0.5) / m.base_total), 0.0)
        return m, past, np.append(m.of, m.k).astype(np.int64), emit, base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, past, of, emit, base = ready()
        table, last = pa.array(m.words, pa.binary()), len(m.words)
        for held in split_batches(batches, 2):
            for (batch, names, codes, sizes), at in zip(held, places_of([names for _, names, _, _ in held], table), strict=True):
                key, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                ids = np.where(at < 0, last, at)[codes]
                h = states(past[ids], m.start)
                known = ids < last
                value = np.where(known, m.move[h, of[ids]] + emit[ids], 0.0)
                starts = np.cumsum(sizes) - sizes
                out = [sizes.astype(np.int64), np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(base[ids], starts), np.add.reduceat(value, starts)]
                own = pa.StructArray.from_arrays([pa.array(x) for x in out], names=["n_tokens", "n_known", "base", "score"])
                # a text's own row has a word of its own, which no text can hold, so that these rows don't meet in one task
                called = [b" %d %d" % x for x in zip(key.tolist(), tag.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(tag), pa.array(called, pa.binary()), pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int32()), own, *batch.columns[3:]], names=sent_schema.names)
                rare = np.flatnonzero(~known)
                doc = np.searchsorted(starts, rare, "right") - 1
                for cell, n in summed([(doc * len(names) + codes[rare]) * m.k + h[rare]]):
                    for i in range(0, len(cell), 200_000):
                        row, which = np.divmod(cell[i : i + 200_000] // m.k, len(names))
                        state, times = cell[i : i + 200_000] % m.k, n[i : i + 200_000]
                        yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(tag[row]), names.take(pa.array(which)), pa.array(state.astype(np.int32)), pa.array(times.astype(np.int32)), pa.nulls(len(row), own.type), *(pa.nulls(len(row), c.type) for c in batch.columns[3:])], names=sent_schema.names)

    key, tag = row_keys(docs, keys[0], text_col)
    sent = docs.select(key.alias("key"), tag.alias("tag"), F.col(text_col).cast("binary").alias("text"), *(F.col(k).alias(f"__{i}") for i, k in enumerate(keys))).mapInArrow(lean(run), sent_schema)
    spark = docs.sparkSession
    moves = spark.createDataFrame([(h, c, float(model.move[h, c])) for h in range(model.k) for c in range(model.k + 1)], "h int, class int, move double")
    sizes = spark.createDataFrame([(c, float(model.log_size[c])) for c in range(model.k)], "class int, log_size double")
    words = lex.select("word", F.col("n").alias("c"), "class").join(F.broadcast(sizes), "class")
    found = sent.join(words, "word", "left").withColumn("class", F.coalesce("class", F.lit(model.k)))
    found = found.join(F.broadcast(moves), ["h", "class"], "left")  # at most classes x (classes + 1) rows
    log_word = F.when(F.col("c").isNull(), F.lit(0.0)).otherwise(F.log10(F.col("c") - model.discount) - F.col("log_size"))
    copies = F.count("own")
    of_rare = lambda x: F.coalesce(F.sum(x), F.lit(0)) / copies
    sums = found.groupBy("key", "tag").agg(
        *(F.first(c.name, ignorenulls=True).alias(c.name) for c in carried),
        copies.alias("copies"),
        F.max("own.n_tokens").alias("n_tokens"),
        (F.max("own.n_known") + of_rare(F.when(F.col("c").isNotNull(), F.col("n"))).cast("bigint")).alias("n_known"),
        (F.max("own.base") + of_rare(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / model.base_total))).alias("base_score"),
        (F.max("own.score") + of_rare(F.col("n") * (F.col("move") + log_word))).alias("score"),
    )
    rows = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*(F.col(c.name).alias(k) for c, k in zip(carried, keys, strict=True)), "n_tokens", "n_known", "base_score", "score")


SENT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("tag", T.IntegerType()), T.StructField("word", T.BinaryType()), T.StructField("h", T.IntegerType()), T.StructField("n", T.IntegerType()),
    T.StructField("own", T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType())])),
])


def train(texts: DataFrame, core: int = CORE, classes: int = CLASSES, held: int = HELD, sweeps: int = SWEEPS, rounds: int = ROUNDS) -> tuple[DataFrame, Model]:
    """The lexicon of a frame with one binary column, and the model's tables."""
    every = settle(count_words(texts))
    least, least_core = cut_off(every, held, core + 1)
    top = every.where(F.col("n") >= min(least, least_core)).toArrow()  # max(held, core + 1) rows at most
    found, counts = top.column("word").to_pylist(), top.column("n").to_numpy()
    order = sorted(range(len(found)), key=lambda i: (-counts[i], found[i]))
    found, counts = [found[i] for i in order], counts[order]
    kept = int((counts >= least).sum())
    at_core = [w for w, n in zip(found, counts.tolist(), strict=True) if w and n >= least_core]
    # the end is last, as start and own[-2] expect; words past both bounds are left to the lexicon
    words = [*dict.fromkeys(w for w in [*found[:kept], *at_core] if w), END]
    index = {w: i for i, w in enumerate(words)}
    coded = settle(encode(texts, words))
    places = np.full(len(words), -1)
    places[[index[w] for w in at_core]] = np.arange(len(at_core))
    places[-1] = len(at_core)
    core_of = exchange(core_bigrams(coded, places, len(at_core) + 1), classes, sweeps)
    k = int(core_of.max()) + 1
    states_from = {*found[:kept], END}
    past = np.array([w in states_from for w in words])
    of = cluster(coded, np.where(places >= 0, core_of[places], -1), past, k, rounds)
    history = np.where(past, of, -1)
    gains = gains_of(class_pairs(coded, of, history, k), int(of[-1]))
    lex = settle(held_lexicon(coded, words, of, history).union(rare_lexicon(coded, of, history, gains)))
    return lex, Model(lex, found[:kept], counts[:kept], of[[index[w] for w in found[:kept]]] if kept else np.zeros(0, np.int64), k, int(of[-1]))


def brown_lm(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1, **options) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"), (fold_of(id_col, folds) == held_fold).alias("held_out"))
    lex, model = train(rows.where(~F.col("held_out")).select(F.col("__text").cast("binary")), **options)
    out = score(rows, lex, model, [id_col, "held_out"], "__text")
    return out.select(id_col, "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm(read(spark, sf_dir, "documents"))
