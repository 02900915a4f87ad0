"""Language of documents, by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_texts
from tickloom.operators.ordered import latest_per_key, newest_n_per_key

UNDETERMINED = "und"
# The training sample: documents of a language, and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 100, 1_500
# Network and training.
HIDDEN, EPOCHS, BATCH, RATE, SEED = 8, 2, 256, 0.02, 7
# The state starts anew with each word; longer words are cut.
LONGEST = 24
# Distinct words whose results a worker remembers, and words that it looks up at once.
REMEMBERED, AT_ONCE = 400_000, 500_000

_LETTER = re.compile(r"[^\W\d_]")
# Bytes that count for a document: ASCII letters and all of UTF-8 beyond ASCII.
_COUNTS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


class BiGru:
    """Two gated recurrent networks, one per direction, and a softmax at every position.

    With ``z, r = sigmoid(x + h U)`` and ``c = tanh(x + r * (h U + b))`` the state becomes
    ``z * h + (1 - z) * c``. A byte's input is a row of a table, as for a one-hot vector.
    """

    def __init__(self, n_classes: int, hidden: int, rng: np.random.Generator):
        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.2).astype(np.float32)

        self.hidden = hidden
        self.weights = {"out": normal(2 * hidden, n_classes), "out_bias": np.zeros(n_classes, np.float32)}
        for way in ("f", "b"):
            self.weights |= {
                f"in_{way}": normal(256, 3 * hidden),
                f"rec_{way}": normal(hidden, 3 * hidden),
                f"bias_{way}": np.zeros(hidden, np.float32),
            }

    def _states(self, data: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step (steps x words x hidden); data is words x steps."""
        w_in, w_rec, bias = (self.weights[f"{k}_{way}"] for k in ("in", "rec", "bias"))
        n, steps = data.shape
        size = self.hidden
        h = np.zeros((n, size), np.float32)
        states, saved = np.empty((steps, n, size), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            x, g = w_in[data[:, t]], h @ w_rec
            gates = 0.5 + 0.5 * np.tanh(0.5 * (x[:, : 2 * size] + g[:, : 2 * size]))
            z, r = gates[:, :size], gates[:, size:]
            inner = g[:, 2 * size :] + bias
            c = np.tanh(x[:, 2 * size :] + r * inner)
            if keep:
                saved.append((t, h, z, r, inner, c))
            h = c + z * (h - c)
            states[t] = h
        return states, saved

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Class probabilities of each position (steps x words x classes)."""
        both = np.concatenate([self._states(data, way, False)[0] for way in ("f", "b")], axis=2)
        return _softmax(both @ self.weights["out"] + self.weights["out_bias"])

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions, back through time."""
        size, w = self.hidden, self.weights
        ran = {way: self._states(data, way, True) for way in ("f", "b")}
        both = np.concatenate([ran["f"][0], ran["b"][0]], axis=2)
        d_out = _softmax(both @ w["out"] + w["out_bias"])
        d_out[:, np.arange(len(labels)), labels] -= 1
        d_out /= data.size
        flat = d_out.reshape(-1, d_out.shape[2])
        grads = {"out": both.reshape(-1, 2 * size).T @ flat, "out_bias": flat.sum(0)}
        d_both = d_out @ w["out"].T
        for way, part in (("f", d_both[:, :, :size]), ("b", d_both[:, :, size:])):
            d_in, d_rec, d_bias = (np.zeros_like(w[f"{k}_{way}"]) for k in ("in", "rec", "bias"))
            d_h = np.zeros((len(labels), size), np.float32)
            for t, h, z, r, inner, c in reversed(ran[way][1]):
                d_h = d_h + part[t]
                d_c = d_h * (1 - z) * (1 - c * c)
                d_z = d_h * (h - c) * z * (1 - z)
                d_r = d_c * inner * r * (1 - r)
                d_x = np.concatenate((d_z, d_r, d_c), axis=1)
                d_g = np.concatenate((d_z, d_r, d_c * r), axis=1)
                np.add.at(d_in, data[:, t], d_x)
                d_rec += h.T @ d_g
                d_bias += (d_c * r).sum(0)
                d_h = d_h * z + d_g @ w[f"rec_{way}"].T
            grads |= {f"in_{way}": d_in, f"rec_{way}": d_rec, f"bias_{way}": d_bias}
        return grads


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _parts(word: bytes) -> list[bytes]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, bytes)`` of words of one length at a time, a few thousand together."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for some in np.array_split(places, len(places) // 4096 + 1):
            joined = b"".join([words[i] for i in some.tolist()])
            yield some, np.frombuffer(joined, np.uint8).reshape(len(some), length)


class LanguageModel:
    """The learned languages, in order, and the network."""

    def __init__(self, languages: list[str], network: BiGru | None):
        self.languages, self.network = languages, network

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Per word and language: summed probabilities of the positions that count, then the
        number of those positions that the language is the label of."""
        n = len(self.languages)
        out = np.zeros((len(words), 2 * n), np.float32)
        parts = [(i, p) for i, w in enumerate(words) for p in _parts(w)]
        owner = np.array([i for i, _ in parts], np.int64)
        for places, data in _by_length([p for _, p in parts]):
            p = self.network.probabilities(data)
            counts = _COUNTS[data.T][:, :, None]
            labels = p.argmax(axis=2)[:, :, None] == np.arange(n)
            rows = np.concatenate(((p * counts).sum(0), (labels & counts).sum(0)), axis=1)
            np.add.at(out, owner[places], rows)
        return out


def learn_languages(sample: list[tuple[str, bytes]], seed: int = SEED) -> LanguageModel:
    """A model of the languages in ``(language, text)`` pairs, trained on their words.

    Words are drawn evenly over the languages. Training is deterministic.
    """
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return LanguageModel([], None)
    rng = np.random.default_rng(seed)
    per_language = [
        [p for lang, text in sample if lang == language for w in text.split() for p in _parts(w)]
        for language in languages
    ]
    most = max(map(len, per_language))
    words, labels = [], []
    for label, own in enumerate(per_language):
        picked = rng.permutation(np.resize(np.arange(len(own)), most)) if own else []
        words += [own[i] for i in picked]
        labels += [label] * len(picked)
    network = BiGru(len(languages), HIDDEN, rng)
    label_of = np.array(labels, np.int64)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for epoch in range(EPOCHS):
        batches = []
        for length in np.unique(lengths):
            places = rng.permutation(np.flatnonzero(lengths == length))
            batches += np.array_split(places, len(places) // BATCH + 1)
        for number in rng.permutation(len(batches)):
            some = batches[number]
            data = np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), -1)
            grads = network.gradients(data, label_of[some])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():  # Adam
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                network.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return LanguageModel(languages, network)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: its crc32 leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS
) -> list[tuple[str, bytes]]:
    """Up to ``per_language`` labelled documents of each language, cut to ``chars`` code points.

    Documents are taken in the order of a hash of their text, each text of a language once, so
    that neither missing nor repeated ids fill the sample. The places in that order are cut to
    ``per_language`` in every task and again after the shuffle; then the taken texts are cut to
    one row each in the same way. The driver gets no more rows than that.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    placed = usable.select("lang", F.xxhash64("text").alias("place"), F.substring("text", 1, chars).alias("text"))
    first = newest_n_per_key(placed.select("lang", "place").distinct(), "lang", ["place"], per_language, "number")
    taken = F.lit(False)
    for row in first.groupBy("lang").agg(F.min("place").alias("least")).collect():
        taken = F.when(F.col("lang") == row["lang"], F.col("place") >= row["least"]).otherwise(taken)
    rows = latest_per_key(placed.where(taken), ["lang", "place"], ["text"]).collect()
    rows.sort(key=lambda r: (r.lang, -r.place))
    return [(row.lang, row.text.encode()) for row in rows]


def _identifier(model: LanguageModel):
    n = len(model.languages)

    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        known: dict[bytes, int] = {}
        scores = np.empty((0, 2 * n), np.float32)
        for texts in batches:
            names, values, labelled = [], [], []
            begin = 0
            while begin < len(texts):
                # As many texts as make up so many words, one at least.
                split, size, end = [], 0, begin
                while end < len(texts) and (size < AT_ONCE or end == begin):
                    split.append(texts[end].split() if texts[end] else [])
                    size += len(split[-1])
                    end += 1
                if len(known) > REMEMBERED:
                    known, scores = {}, scores[:0]
                if n:
                    new = list({w for words in split for w in words}.difference(known))
                    known |= zip(new, range(len(known), len(known) + len(new)), strict=True)
                    scores = np.concatenate((scores, model.word_scores(new)))
                for text, words in zip(texts[begin:end], split, strict=True):
                    found = (UNDETERMINED, 0.0, {})
                    if n and text and _LETTER.search(text.decode()):
                        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                        sums = scores[ids].sum(axis=0, dtype=np.float64)
                        positions = sums[:n].sum()
                        if positions > 0:
                            best = int(sums[:n].argmax())
                            counts = zip(model.languages, sums[n:].round().astype(int).tolist(), strict=True)
                            found = (model.languages[best], float(sums[best] / positions), dict(counts))
                    names.append(found[0])
                    values.append(min(found[1], 1.0))
                    labelled.append(list(found[2].items()))
                begin = end
            yield [names, values, labelled]

    return work


def identify_languages(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``(doc, lang_pred, score, positions)``, one row per document row.

    ``doc`` holds the columns ``keep`` of ``docs`` (all, if None); only ``text`` is looked at. Every
    byte of the text gets language probabilities from the network, which reads each word (split
    at ASCII white space) in both directions. ``positions`` counts the letters' bytes by their
    most probable language. The document's probabilities are the mean over those bytes;
    ``lang_pred`` is the largest and ``score`` its value.

    A text that is null or holds no letter, and any text if no language was learned, is ``und``
    with score 0. Ties go to the first language by code point. Repeated documents get equal
    rows. Other columns have no influence. No document, no row.

    Rows are streamed and nothing is shuffled. As the state starts anew with each word, a word
    has one result, which a worker computes once and remembers, up to a bound.
    """
    return map_texts(
        docs, "lang_pred string, score double, positions map<string,long>", _identifier(model), keep
    )
