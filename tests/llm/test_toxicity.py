"""Toxicity: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import random

import numpy as np

from millrace.llm.toxicity import WINDOW, Net, Scorer, train, windows_of, with_toxicity


def labelled(n, seed):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        words = [rnd.choice(["the", "of", "lorem", "ipsum", "dolor", "amet", f"w{rnd.randrange(300)}"]) for _ in range(rnd.randint(5, 90))]
        if k % 3 == 0:
            words[rnd.randrange(len(words))] = rnd.choice(["nasty", "vile", "nastyish", "nastyly."])
        out.append((" ".join(words), int(k % 3 == 0)))
    return out


def test_gradients_match_differences():
    net, words = Net.fresh(1), [b"ab", b"cde", b"fghij"]
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows = np.zeros((2, WINDOW), np.int32)
    windows[0, :3], windows[1, :2] = (1, 2, 3), (3, 1)
    labels, kept = np.array([1.0, 0.0]), np.ones(3)

    def loss():
        logit = net.logits(net.inputs(net.features(words)[0].astype(np.float64)), windows).astype(np.float64)
        return np.mean(np.logaddexp(0, logit) - labels * logit)

    grads = net.gradients(windows, labels, words, kept)
    for name in ("Wf", "Ur", "cr", "af", "vr", "b"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for k in range(0, len(flat), 7):
            old = flat[k]
            flat[k] = old + 1e-2
            up = loss()
            flat[k] = old - 1e-2
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-2 - g[k]) < 2e-3, name


def test_held_out_accuracy_and_windows():
    net = train([(t.encode(), y) for t, y in labelled(300, 1)])
    held = labelled(90, 2)
    scores = Scorer(net).scores([t.encode() for t, _ in held])
    assert np.mean((scores >= 0.5) == [y for _, y in held]) >= 0.95
    long = "the of lorem ipsum " * 3000
    assert Scorer(net).scores([(long + "nasty vile " + long).encode()])[0] > 0.5 > Scorer(net).scores([long.encode()])[0]
    for n in (0, 1, WINDOW, WINDOW + 1, 100):
        assert set(windows_of(np.arange(1, n + 1)).ravel()) - {0} == set(range(1, n + 1))


def test_odd_rows(documents, text_spark):
    rows = [(k, t, "s") for k, (t, _) in enumerate(labelled(60, 3))] + [(100, None, "s"), (101, "", "s"), (None, "nasty", "s"), (5, "again", "s")]
    labels = text_spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = with_toxicity(documents(rows).withColumnRenamed("lang", "toxic"), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["toxicity"] <= 1 for r in got)
    none = with_toxicity(documents(rows[:3]), labels.limit(0)).collect()
    assert all(r["toxicity"] < 0.5 for r in none)
    assert with_toxicity(documents([]), labels).collect() == []
