import random
import zlib

import numpy as np
import pytest

from perispark.llm import quality, toxicity
from perispark.llm.common import held_out, training_texts, within
from tests.llm.helpers import DOCS, documents, edge_documents, sentence, table

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(n=400, seed=3):
    """Good prose, bad symbol noise, and toxic words strewn into some texts."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        good, toxic = int(rng.random() < 0.7), int(rng.random() < 0.3)
        words = sentence(rng, rng.randint(20, 200)).split()
        if not good:
            words = [w.upper() + rng.choice(["***", "%%%"]) for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "grimword", "foulword"]))
        docs.append((1000 + i, " ".join(words), "en", "s", 1))
        labels.append((1000 + i, good, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = labelled()
    labels += [labels[0], (None, 1, 1), (7, None, None), (999999, 1, 0), (8, 1, 0), (9, 1, 0)]
    return documents(spark, docs + edge_documents()), spark.createDataFrame(labels, LABELS), docs, labels


@pytest.mark.parametrize("module, label, least", [(quality, 1, 0.3), (toxicity, 2, 0.5)])
def test_held_out_accuracy_and_rows(spark, data, module, label, least):
    docs, labels, rows, marks = data
    got = module.score(docs, labels).collect()
    assert len(got) == len(rows) + len(edge_documents())
    truth = {m[0]: m[label] for m in marks[:len(rows)]}
    unseen = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(unseen) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= least) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    twice = [r.score for r in got if r.doc_id == 2]
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_a_class_and_without_rows(spark, data, module):
    docs, labels, *_ = data
    one = spark.createDataFrame([(1001, 1, 1), (1002, 1, 1), (1003, 1, 1), (1004, 1, 1)], LABELS)
    assert {r.score for r in module.score(docs, one).collect()} == {1.0}
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in module.score(docs, none).collect()} == {1.0 if module is quality else 0.0}
    assert module.score(spark.createDataFrame([], DOCS), labels).count() == 0


def test_sample_is_bounded_and_leaves_out_held_out_rows(spark, data):
    docs, labels, *_ = data
    sample = training_texts(docs, labels, "toxic", 20)
    assert len(sample) <= 40
    kept = {r.text for r in docs.where(held_out()).collect()} - {r.text for r in docs.where(~held_out()).collect()}
    assert not kept & {t for t, _ in sample}


def test_labelled_texts_are_sampled_whole_within_a_budget(spark, data):
    labels = data[1]
    long = [(1000 + i, "word " * 40_000 + f"end{i}", "en", "s", 1) for i in range(12)]
    sample = training_texts(documents(spark, long), labels, "quality", 50)
    assert sample and {t for t, _ in sample} <= {r[1] for r in long}
    assert within([(1, 5), (2, 50), (3, 4), (4, 2)], 10) == [1, 3]
    some = training_texts(documents(spark, long), labels, "quality", 50, budget=450_000)
    assert {c: sum(1 for _, k in some if k == c) for c in (0, 1)} == {c: min(2, sum(1 for _, k in sample if k == c)) for c in (0, 1)}


def test_gradients_match_differences():
    net = toxicity.Network()
    rng = np.random.default_rng(1)
    net.p = {k: (v + 0.1 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in net.p.items()}
    words = ["alpha", "beta", "gamma", "d"]
    at = np.array([[0, 1, 2, -1], [3, 3, 0, 1], [2, -1, -1, -1]])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        z = net.logits(net.project(net.embed(words)[0]), at)
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

    g, (d_words, buckets, grams, counts) = net.gradients(words, at, y)
    for k in ("word", "gram"):
        g[k] = np.zeros_like(net.p[k])
    np.add.at(g["word"], buckets, d_words)
    np.add.at(g["gram"], grams, np.repeat(d_words / counts[:, None], counts, axis=0))
    for k, v in net.p.items():
        places = [tuple(p) for p in np.argwhere(np.abs(g[k]) > 1e-4)[:6]]
        for place in places:
            old = v[place]
            v[place] = old + 1e-3
            high = loss()
            v[place] = old - 1e-3
            low = loss()
            v[place] = old
            assert abs((high - low) / 2e-3 - g[k][place]) < 2e-3 + 0.03 * abs(g[k][place]), (k, place)


def test_windows_cover_every_word_and_long_texts_are_read_to_the_end():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        cut = toxicity.windows(np.arange(n))
        assert set(cut[cut >= 0].tolist()) == set(range(n)) and cut.shape[1] == toxicity.WINDOW
        assert all(b[0] - a[0] == toxicity.STRIDE for a, b in zip(cut, cut[1:]))
    docs, labels = labelled(300)
    net = toxicity.train([(d[1], m[2]) for d, m in zip(docs, labels)], 0.3, steps=80)
    clean = sentence(random.Random(8), 5000)
    z = toxicity.text_logits(net, [clean, clean + " vileword", "", None, "vileword"])
    assert z[1] > z[0] + 1 and z[2] == z[3] and z[4] > z[2]


def test_full_word_table_starts_anew(monkeypatch):
    net = toxicity.Network()
    texts = [sentence(random.Random(i), 50) + f" only{i}" for i in range(10)]
    whole = toxicity.text_logits(net, texts)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 20)
    table = toxicity.WordTable(net)
    assert np.allclose(np.concatenate([toxicity.text_logits(net, [t], table) for t in texts]), whole, atol=1e-5)
    assert np.allclose(toxicity.text_logits(net, texts, words_at_once=60, at_once=3), whole, atol=1e-5)


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (0.001, 0.0), (1.0, 40.0), (50.0, -300.0)])
def test_calibration_parts_separable_classes_at_any_scale(scale, shift):
    rng = np.random.default_rng(2)
    z = np.r_[rng.normal(-6, 2, 500).clip(max=3), rng.normal(9, 0.4, 500)] * scale + shift
    y = np.r_[np.zeros(500), np.ones(500)]
    a, b = quality.logistic(z[:, None], y, np.where(y == 1, 0.2, 1.8))
    assert (((a + b * z) > 0) == (y == 1)).all()


def by_word(net, text):
    """Logits of all windows of a text, one word and one window at a time."""
    p, h = {k: v.astype(float) for k, v in net.p.items()}, toxicity.HIDDEN
    words, found = toxicity.split_words(text), []
    for start in toxicity.window_starts(len(words)):
        window = words[start:start + toxicity.WINDOW]
        embedded = []
        for w in window:
            data = b"\x02" + w.lower().encode() + b"\x03"
            grams = [((data[i] * 2654435761 + data[i + 1] * 2246822519 + data[i + 2] * 3266489917) % 2 ** 32 >> 18) % toxicity.NGRAM_BUCKETS for i in range(len(data) - 2)]
            embedded.append(p["word"][zlib.crc32(data) % toxicity.WORD_BUCKETS] + np.mean([p["gram"][g] for g in grams], axis=0))
        states = [np.zeros(2 * h) for _ in window]
        for k, side in enumerate("fb"):
            state = np.zeros(h)
            for i in (range(len(window)) if side == "f" else reversed(range(len(window)))):
                x, inner = embedded[i] @ p[f"{side}x"] + p[f"{side}b"], state @ p[f"{side}h"]
                reset, update = (1 / (1 + np.exp(-(x[a:b] + inner[a:b]))) for a, b in ((0, h), (h, 2 * h)))
                state = update * state + (1 - update) * np.tanh(x[2 * h:] + reset * inner[2 * h:])
                states[i][k * h:(k + 1) * h] = state
        energy = [float(np.tanh(s @ p["va"] + p["vb"]) @ p["vc"]) for s in states]
        weight = np.exp(np.array(energy) - max(energy)) if energy else np.zeros(0)
        pooled = sum((w * s for w, s in zip(weight / weight.sum(), states)), np.zeros(2 * h)) if energy else np.zeros(2 * h)
        found.append(float(pooled @ p["out"] + p["bias"][0]))
    return found


def test_scores_equal_a_pass_word_by_word():
    rng = random.Random(4)
    docs, labels = labelled(120)
    net = toxicity.train([(d[1], m[2]) for d, m in zip(docs, labels)], 0.3, steps=20)
    texts = ["", "one", sentence(rng, 31), sentence(rng, 32), sentence(rng, 33), sentence(rng, 100) + " ñandú 日本語", "x" * 500 + " vileword", docs[0][1]]
    want = [max(by_word(net, t)) for t in texts]
    assert np.allclose(toxicity.text_logits(net, texts), want, atol=2e-4)
    a, b = net.calibration
    scorer = toxicity.Scorer(net, 0.3)
    assert np.allclose(scorer(texts + texts[:3] + [None]), 1 / (1 + np.exp(-np.clip(a + b * np.array(want + want[:3] + want[:1]), -30, 30))), atol=1e-3)
    assert len(scorer([])) == 0


def test_long_words_are_cut_into_overlapping_pieces():
    assert toxicity.split_words("ab " + "c" * 64) == ["ab", "c" * 64]
    for n in (65, 96, 97, 128, 1000):
        word = "".join(chr(97 + i % 26) for i in range(n))
        pieces = toxicity.split_words(word + " end")[:-1]
        assert all(len(p) <= 64 for p in pieces) and "".join(p[:32] for p in pieces[:-1]) + pieces[-1] == word
    docs, labels = labelled(300)
    net = toxicity.train([(d[1], m[2]) for d, m in zip(docs, labels)], 0.3, steps=80)
    clean = sentence(random.Random(8), 3000).replace(" ", "")
    z = toxicity.text_logits(net, [clean, clean[:9000] + " vileword grimword foulword " + clean[9000:]])
    assert z[1] > z[0]


def test_a_passage_anywhere_in_a_long_labelled_text_is_learned():
    """Each toxic text of the sample has 200,000 characters and its words at one place only."""
    rng, sample = random.Random(12), []
    for i in range(30):
        words = sentence(rng, 36_000 if i % 2 else 200).split()
        if i % 2:
            at = int(len(words) * (i / 30))
            words[at:at] = ["vileword", "grimword", "foulword"] * 2
        sample.append((" ".join(words), i % 2))
    assert len(sample[1][0]) > 190_000
    net = toxicity.train(sample, 0.5, steps=160)
    clean = sentence(rng, 400)
    z = toxicity.text_logits(net, [clean, clean + " grimword vileword foulword " + sentence(rng, 40)])
    assert z[1] > z[0] + 1


def test_compressed_sizes_equal_a_second_path(spark, data):
    import zstandard

    docs, labels, rows, _ = data
    model = quality.fit(docs, labels)
    for text in [r[1] for r in rows[:12]] + ["", "x", "é" * 5000]:
        sizes = []
        for side in (model.bad, model.good):
            total, raw = 0, text.encode()
            for d in side:
                whole = zstandard.ZstdCompressionDict(d)
                for k in range(0, len(raw), quality.BLOCK_BYTES):
                    frame = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=whole, write_content_size=False, write_dict_id=False).compress(raw[k:k + quality.BLOCK_BYTES])
                    assert zstandard.ZstdDecompressor(dict_data=whole).decompress(frame, max_output_size=quality.BLOCK_BYTES) == raw[k:k + quality.BLOCK_BYTES]
                    total += len(frame) - quality.FRAME_BYTES
            sizes.append(total)
        b, g = sizes
        want = ((b - g) / max(b + g, 1), (b - g) / (len(text.encode()) * len(model.good))) if text else (0.0, 0.0)
        got = quality.differences(model, text)
        assert got == pytest.approx(want, abs=0.02)
        x = np.array([got[0], got[1], min(got[1], model.knee)])
        z = model.weights[0] + ((x - model.centre) / model.spread) @ np.array(model.weights[1:])
        assert quality.score_texts(model, [text])[0] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))
