"""Language ID: a linear-chain conditional random field labels words; a text's language is its labels' sum."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import apart, ship

#: Labelled documents of each language that the model is fitted on at most, words of each that it reads, and most frequent languages it learns.
FIT_DOCS, FIT_WORDS, FIT_LABELS = 200, 100, 200
#: Hashed features, passes over the sample, step size.
FEATURES, EPOCHS, RATE = 1 << 16, 3, 0.4
#: Words of a worker whose features are remembered; the memory is cleared when full.
REMEMBERED = 1 << 18
#: New words scored together.
NEW_WORDS = 1 << 14
#: Sequences of a fitting step, and words of the stretches of one language they are made of.
STEP_SEQUENCES, STRETCH = 32, 12
#: Parts of a fitting text that are read, at hashed places over the whole of it, and characters of each.
PARTS, PART_CHARS = 4, 150
#: Texts of an Arrow batch that are split into words together, and their bytes.
TURN_ROWS, TURN_BYTES = 2000, 1 << 21

_WORD = regex.compile(r"[\p{L}\p{M}']*\p{L}[\p{L}\p{M}']*")


def _slots(word: str) -> list[int]:
    """Hashed features: the word itself (lexicon), its affixes and its letter n-grams."""
    w = f"<{word}>".encode("utf-32-le")  # four bytes a letter
    end = len(w)
    slots = {crc32(w) % FEATURES}
    for n in (8, 12, 16):
        slots.add(crc32(w[:n], 1) % FEATURES)
        slots.add(crc32(w[-n:], 2) % FEATURES)
    for n in (4, 8, 12):
        slots.update([crc32(w[i:i + n], 3) % FEATURES for i in range(4, end - n, 4)])
    return list(slots)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _forward_backward(score: np.ndarray, move: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals of each word and expected moves, for sequences ``score[sequence, word, label]`` sorted by falling length."""
    emit = np.exp(score - score.max(2, keepdims=True))
    n, steps, k = emit.shape
    alpha, beta = np.zeros_like(emit), np.ones_like(emit)
    live = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]  # sequences longer than t
    alpha[:, 0] = emit[:, 0] / np.maximum(emit[:, 0].sum(1, keepdims=True), 1e-30)
    for t in range(1, steps):
        m = live[t]
        a = (alpha[:m, t - 1] @ move) * emit[:m, t]
        alpha[:m, t] = a / a.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        m = live[t + 1]
        b = (emit[:m, t + 1] * beta[:m, t + 1]) @ move.T
        beta[:m, t] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(2, keepdims=True), 1e-30)
    return gamma, (alpha, beta, emit)


def fit(texts: list[str], labels: list[str], seed: int = 7) -> dict:
    """Weights of features and moves, by gradient steps on code-switched sequences cut from the labelled texts.

    The sequences alternate stretches of words of random languages, so that the learned moves know both staying and switching.
    """
    names = sorted(set(labels))
    pool = {name: [] for name in names}
    for text, label in zip(texts, labels):
        pool[label].append(words_of(text)[:FIT_WORDS])
    pool = {name: [w for w in ws if w] for name, ws in pool.items()}
    names = [name for name in names if pool[name]]
    k = len(names)
    weight, move = np.zeros((FEATURES, max(k, 1))), np.zeros((max(k, 1), max(k, 1)))
    if not k:
        return {"names": [], "weight": weight.astype(np.float32), "move": np.exp(move)}
    rng = np.random.default_rng(seed)
    stretches = [(j, ws[i:i + STRETCH]) for j, name in enumerate(names) for ws in pool[name] for i in range(0, len(ws), STRETCH)]
    for epoch in range(EPOCHS):
        order = rng.permutation(len(stretches))
        step = RATE / (1 + epoch)
        for at in range(0, len(order), 3 * STEP_SEQUENCES):
            part = order[at:at + 3 * STEP_SEQUENCES]
            seqs = [sum(([(stretches[x][0], w) for w in stretches[x][1]] for x in part[i:i + 3]), []) for i in range(0, len(part), 3)]
            seqs.sort(key=len, reverse=True)
            length = np.array([len(q) for q in seqs])
            score, gold = np.zeros((len(seqs), length[0], k)), np.full((len(seqs), length[0]), -1)
            slots = {}
            for s, q in enumerate(seqs):
                for t, (label, w) in enumerate(q):
                    f = slots[s, t] = _slots(w)
                    score[s, t], gold[s, t] = weight[f].mean(0) * 8, label
            gamma, (alpha, beta, emit) = _forward_backward(score, np.exp(move), length)
            change = np.zeros_like(move)
            for t in range(1, length[0]):
                m = int((length > t).sum())
                joint = alpha[:m, t - 1, :, None] * np.exp(move)[None] * (emit[:m, t] * beta[:m, t])[:, None, :]
                change -= (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                np.add.at(change, (gold[:m, t - 1], gold[:m, t]), 1)
            move += step * change / length.sum() * 4
            for (s, t), f in slots.items():
                error = -gamma[s, t]
                error[gold[s, t]] += 1
                weight[f] += step * error / len(f) ** 0.5
    return {"names": names, "weight": weight.astype(np.float32), "move": np.exp(move)}


class Lexicon(dict):
    """Rows of ``table`` (emission scores) by word, filled as words come; ``rows`` scores the new ones together."""

    def __init__(self, weight: np.ndarray) -> None:
        super().__init__()
        self.weight, self.table, self.new = weight, np.zeros((REMEMBERED // 8, weight.shape[1]), np.float32), []

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(_slots(word))
        if len(self.new) == NEW_WORDS:
            self._score()
        return at

    def _score(self) -> None:
        n = np.array([len(s) for s in self.new])
        while len(self) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        slots = np.fromiter(chain.from_iterable(self.new), np.int64, n.sum())
        sums = np.add.reduceat(self.weight[slots], np.cumsum(n) - n)
        self.table[len(self) - len(n):len(self)] = sums * 8 / n[:, None]
        self.new = []

    def rows(self, texts: list[list[str]], words: int) -> np.ndarray:
        """Scores of all words, in order."""
        if len(self) > REMEMBERED:
            self.clear()
        at = np.fromiter((i for ws in texts for i in map(self.__getitem__, ws)), np.int64, words)
        if self.new:
            self._score()
        return self.table[at]


def _turns(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``TURN_ROWS`` texts and, but for a longer text on its own, ``TURN_BYTES`` bytes."""
    ends, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(size):
        bound = (ends[at - 1] if at else 0) + TURN_BYTES
        to = min(max(int(np.searchsorted(ends, bound, "right")), at + 1), at + TURN_ROWS, len(size))
        yield at, to
        at = to


def _labelled(batches: Iterator[pa.RecordBatch], model, keep: list[str], text_col: str = "_text") -> Iterator[pa.RecordBatch]:
    spec = model.value
    names, move = spec["names"], spec["move"]
    # Kept with the model: Spark drops both from a worker when tasks of another stage come to it.
    lexicon = spec.get("lexicon")
    if lexicon is None:
        lexicon = spec["lexicon"] = Lexicon(spec["weight"])

    def of_group(texts: list[list[str]]) -> list[np.ndarray]:
        length = np.array([len(ws) for ws in texts])
        inside = np.arange(length[0])[None, :] < length[:, None]
        scores = np.zeros((len(texts), length[0], len(names)), np.float32)
        scores[inside] = lexicon.rows(texts, int(length.sum()))
        gamma, _ = _forward_backward(scores, move, length)
        return list((gamma * inside[:, :, None]).sum(1) / length[:, None])

    for batch in batches:
        language, value = ["und"] * len(batch), [0.0] * len(batch)
        size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        for at, to in _turns(size) if names else ():
            # Texts become Python strings turn by turn: a whole batch of them and their words would fill the worker.
            texts = enumerate(batch.column(text_col).slice(at, to - at).to_pylist(), at)
            words = {i: ws for i, text in texts if (ws := words_of(text))}
            order = sorted(words, key=lambda i: -len(words[i]))
            while order:
                # Groups of like lengths: at most about 200,000 words, padding included.
                n = max(1, min(len(order), 200_000 // len(words[order[0]])))
                group, order = order[:n], order[n:]
                for i, share in zip(group, of_group([words[i] for i in group])):
                    best = int(share.argmax())
                    language[i], value[i] = names[best], float(min(max(share[best], 0.0), 1.0))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(language), pa.array(value, pa.float64())], names=[*keep, "lang_pred", "score"])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score`` (the language's mean share of the word labels).

    The field is fitted on a bounded sample, ``FIT_DOCS`` documents of each label at most (those of the least hashes), from labelled rows that are not
    held out; every whole text is then labelled word by word with forward-backward.  Features of a word are itself, affixes
    and letter n-grams; labels, ids and sources are no inputs.

    A null text or one without letters gives ``und`` and 0; so does a table without labels.  Equal best labels give the first
    by name.  Null ids are not held out and drawn by their text; repeated rows are predicted each; other columns pass through, but those
    named like the three new ones give way to them.
    """
    spark = docs.sparkSession
    ship(spark)
    docs, at, through = apart(docs, "held_out", "lang_pred", "score")
    text_col, label_col, id_col = at(text_col), at(label_col), at(id_col)
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    draw = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string")), F.lit("fit"))
    # Candidates by a hash threshold, from the count of each label; the few left are cut to the bound.
    counts = labelled.groupBy(F.col(label_col).alias("l")).agg(F.count("*").alias("c")).orderBy(F.desc("c")).limit(FIT_LABELS).collect()
    some = None
    for label in counts:
        share = min(1.0, 2 * FIT_DOCS / label.c)
        near = (F.col(label_col) == label.l) & (F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30)))
        some = near if some is None else some | near
    texts, labels = [], []
    if some is not None:
        size = F.char_length(text_col)
        place = lambda i: F.pmod(F.xxhash64(draw, F.lit(i)), F.greatest(size - PART_CHARS, F.lit(0)) + 1).cast("int") + 1
        parts = F.concat_ws(" ", *(F.substr(F.col(text_col), place(i), F.lit(PART_CHARS)) for i in range(PARTS)))
        cut = F.when(size > PARTS * PART_CHARS, parts).otherwise(F.col(text_col))  # of fitting texts only
        rows = labelled.where(some).select(draw.alias("h"), cut.alias("t"), F.col(label_col).alias("l")).collect()
        seen: dict[str, int] = {}
        for row in sorted(rows, key=lambda r: (r.h, r.t)):
            seen[row.l] = seen.get(row.l, 0) + 1
            if seen[row.l] <= FIT_DOCS:
                texts.append(row.t)
                labels.append(row.l)
    model = spark.sparkContext.broadcast(fit(texts, labels))
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    source = docs.select(*(F.col(f"`{c}`") for c in docs.columns), held_out(F.col(id_col)).alias("held_out"))
    if docs.schema[text_col].dataType != StringType():
        source = source.withColumn("_text", F.col(text_col).cast("string"))
        text_col = "_text"  # else the texts go to the workers once
    keep = [c for c in source.columns if c != "_text"]
    schema = StructType([f for f in source.schema.fields if f.name != "_text"] + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return source.mapInArrow(partial(_labelled, model=model, keep=keep, text_col=text_col), schema).select(*through, "held_out", "lang_pred", "score")
