"""Language identification and the quality classifier: held-out accuracy, and a brute-force scorer."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from tape_audit.llm import language, quality

WORDS = {"aa": "the of and that house river".split(), "bb": "der und das nicht haus fluss".split()}
SCHEMA = "doc_id long, text string, lang string, source string, score string, held_out int, label int"


def made(n: int = 400) -> list[tuple]:
    rng, rows = random.Random(2), []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ".", "s"]) for _ in range(30)), lang, "s", "x", 7, 9))
    return rows


EDGES = [(None, "the river", None, None, None, None, None), (900, None, "aa", None, None, None, None), (901, "", "bb", "s", None, None, None),
         (902, "123 !! 456", "aa", "s", None, None, None), (903, "the " * 300_000, None, "s", None, None, None), (904, "Ωψ", None, None, None, None, None),
         (904, "Ωψ", None, None, None, None, None)]


def test_languages(spark):
    rows = made() + EDGES
    got = language.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["held_out"] for r in got if r["doc_id"] is not None} == {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows if r[0] is not None}
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    held = [r for r in rows[:400] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(pred[r[0]][0] == r[2] for r in held) / len(held) > 0.95
    assert pred[900] == pred[901] == pred[902] == ("und", 0.0)
    assert pred[903][0] == "aa" and pred[None][0] == "aa" and pred[904][0] in ("aa", "bb")
    assert all(0 <= s <= 1 for _, s in pred.values())


def test_no_labels_and_no_rows(spark):
    unlabelled = [(1, "words here", None, "s", None, None, None)]
    assert [(r["lang_pred"], r["score"]) for r in language.identify(spark.createDataFrame(unlabelled, SCHEMA)).collect()] == [("und", 0.0)]
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("known", [3, 1000])
def test_scores_equal_brute_force(known):
    model = language.build(["aa", "bb"], ["the", "und", "\x01t", "\x01th", "\x01u", "\x01 "], np.array([[9, 0], [1, 7], [5, 4], [4, 0], [0, 3], [2, 2]]))
    for text in ("the und", "thu tu the 12 und!", "Und THE ttu", "x"):
        total = [0.0, 0.0]
        for token in text.lower().split():
            bare = token.strip("12!")
            if bare in model.rows:
                rows = [model.rows[bare]]
            else:
                padded, rows = f" {bare} ", []
                for i in range(len(padded) - 1 if bare else 0):
                    hits = [model.rows["\x01" + padded[i : i + n]] for n in (4, 3, 2, 1) if "\x01" + padded[i : i + n] in model.rows]
                    rows.append(hits[0] if hits else len(model.weights) - 1)
            for k in range(2):
                total[k] += sum(model.weights[r][k] for r in rows) / max(1, len(rows))
        total = [x / math.sqrt(len(text.split())) for x in total]
        share = [math.exp(x) / sum(math.exp(y) for y in total) for x in total]
        lang, score = language.Scorer(model, known).predict(text)
        assert lang == model.languages[share.index(max(share))] and score == pytest.approx(max(share))


def junk(rng: random.Random, text: str) -> str:
    return rng.choice([lambda: " | ".join(text.split()), lambda: " ".join(w for w in text.split()[:4] for _ in range(9)), lambda: text.replace(" ", "%%% ")])()


def test_quality(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i, row in enumerate(made(600)):
        bad = rng.random() < 0.3
        docs.append((i, row[1] + "\n" + junk(rng, row[1]) if bad else row[1] + "\n" + made(1)[0][1], *row[2:]))
        labels.append((i, int(not bad), 0))
    frame = spark.createDataFrame(docs + EDGES, SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.scores(frame, marks).collect()
    assert len(got) == len(docs) + len(EDGES)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    pred = {r["doc_id"]: r["predicted"] for r in got}
    held = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert sum(pred[d] == q for d, q, _ in held) / len(held) > 0.9
    none = quality.scores(frame, marks.where("false")).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert quality.scores(frame.where("false"), marks).collect() == []


def test_gradients_equal_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    net = quality.Network.new(np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    x, sizes, y = rng.standard_normal((7, quality.WIDTH)), np.array([2, 4, 1]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(np.log(np.where(y == 1, p := net.score(x, sizes), 1 - p)))
    for weights, grad in zip(net.weights, net.gradients(x, sizes, y), strict=True):
        at = tuple(rng.integers(0, s) for s in weights.shape)
        keep, step = weights[at], 1e-5
        weights[at] = keep + step
        up = loss()
        weights[at] = keep - step
        down = loss()
        weights[at] = keep
        assert grad[at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


@pytest.mark.parametrize(("text", "letters"), [("½ ² ① Ⅷ 3 _", False), ("½ é", True), ("中", True), ("", False), ("_a_", True)])
def test_letters_are_category_l(text, letters):
    assert language.has_letter(text) is letters
