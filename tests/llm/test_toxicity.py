import zlib

import numpy as np
import pytest

from catkeep.llm import toxicity
from catkeep.llm.queries import op2_toxicity
from tests.llm.helpers import documents, no_documents, odd_documents, table


def test_gradients():
    net = toxicity.Network.fresh()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    words = ["abc", "defgh", "xyz", "ugly"]
    windows = np.full((3, toxicity.WINDOW), -1)
    windows[0, :5], windows[1, :3], windows[2, :1] = [0, 1, 2, 3, 1], [2, 2, 3], [1]
    y = np.array([1, 0, 1.0])
    found = toxicity.gradients(net, words, windows, y)

    def loss():
        p = toxicity._sigmoid(net.logits(*toxicity._gather(net.inputs(words), windows))[0])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, weight in net.weights.items():
        at = np.unravel_index(np.abs(found[name]).argmax(), weight.shape)
        weight[at] += 1e-3
        up = loss()
        weight[at] -= 2e-3
        down = loss()
        weight[at] += 1e-3
        assert found[name][at] == pytest.approx((up - down) / 2e-3, rel=1e-3, abs=1e-6), name


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        windows = toxicity._windows(np.arange(n))
        assert set(windows.ravel()) - {-1} == set(range(n))
        for a, b in zip(windows[:-1], windows[1:], strict=True):
            assert len(set(a) & set(b) - {-1}) == toxicity.WINDOW - toxicity.STRIDE


@pytest.fixture(scope="module")
def net():
    toxic = ["you are a vile rotten thing", "so vile it is", "rotten rotten words here"] * 8
    clean = ["a nice day it is", "words here and there", "the thing is nice"] * 8
    return toxicity.fit(toxic + clean, [1] * 24 + [0] * 24)


def test_one_bad_window_decides_wherever_it_stands(net):
    score = toxicity.Scorer(net)
    filler = "a nice day it is and the words here " * 400
    low, *high = score([filler, filler + "vile rotten", "vile rotten " + filler, filler + "rotten vile " + filler])
    assert low < 0.5 < min(high)


def test_scores_do_not_depend_on_the_batch(net):
    texts = [None, "", "vile", "nice day " * 500, "漢字 🙂"]
    together = toxicity.Scorer(net)(texts)
    assert np.allclose(together, [toxicity.Scorer(net)([t])[0] for t in texts], atol=1e-6)
    assert together[0] == together[1] and ((together >= 0) & (together <= 1)).all()


def test_odd_rows(spark, net):
    frame = odd_documents(spark, score="clash", predicted="clash")
    rows = toxicity.score(frame, net).collect()
    assert len(rows) == frame.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.score(no_documents(spark), net).count() == 0


def test_without_labels_every_text_gets_the_share(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net = toxicity.train(documents(spark, ["a", None]), labels)
    assert {round(r["score"], 6) for r in toxicity.score(documents(spark, ["a", None, "b c"]), net).collect()} == {0.25}
    known = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.train(documents(spark, ["a", "b", "c"]), known).shift < 0


def test_one_row_of_a_repeated_id_is_learnt(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    rows = [(i, f"text {i} {n}") for i in ids for n in range(50 if i == ids[0] else 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)] + [(ids[1], 1)], "doc_id long, toxic int")
    learnt = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, share: learnt.append((texts, toxic)))
    for _ in range(2):
        toxicity.train(frame.repartition(3, "text"), labels, sample=8)
    assert learnt[0] == learnt[1]
    texts, toxic = learnt[0]
    assert [int(t.split()[1]) for t in texts] == [ids[0], ids[1], ids[1], ids[2], ids[3]]
    assert toxic == [0, 1, 1, 0, 1]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    rows = op2_toxicity(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    judged = [(r["predicted"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert len(judged) > 50
    assert sum(p == t for p, t in judged) / len(judged) > 0.92
    assert sum(p for p, t in judged if t) / sum(t for _, t in judged) >= 0.5
