"""Licence scans, centroid clusters and periodic runs against plain versions, and the cases that tables may hold."""

import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

from gripelode.llm import centroids, licenses, runs

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# --- licence scans


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def base_places(words):
    found = []
    for t in licenses.BASE:
        p = t.text.split()
        found += [(i, t.label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return found


def scanned(docs, rows, **options):
    return sorted(licenses.report(docs(rows), **options).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))


def test_base_phrases_equal_brute_force(docs):
    rng = random.Random(1)
    vocabulary = "under the mit license apache version 2 cc by nc a b 0".split()
    joins = [" ", ", ", "-", "\n", "\x00", " / ", "_"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rng.randrange(40)):
            words += rng.choice(licenses.BASE).words if rng.random() < 0.3 else [rng.choice(vocabulary)]
        words = [w.upper() if rng.random() < 0.3 else w for w in words]
        rows.append((i, "".join(w + rng.choice(joins) for w in words)))
    for (_, text), r in zip(rows, scanned(docs, rows)):
        words = license_words(text)
        places = base_places(words)
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("template", [t for t in licenses.NOTICES if t.phrases], ids=lambda t: t.label)
def test_notices_are_found_where_words_are_changed(docs, template):
    words = template.words
    kept = {w for p in template.phrases for w in p.split()}
    loose = [i for i, w in enumerate(words) if w not in kept]
    changed = list(words)
    if loose:
        changed[loose[0]] = "changed"
    whole, lightly = "x " * 50 + "* ".join(words) + " y" * 50, "x " * 30 + " ".join(changed)
    without = " ".join(w for w in words if w not in template.phrases[0].split())
    found = scanned(docs, [(1, whole), (2, lightly), (3, without), (4, " ".join(reversed(words)))])
    assert template.label in found[0]["labels"].split(",") and found[0]["score"] == 1
    assert template.label in found[1]["labels"].split(",")
    assert template.label not in found[2]["labels"].split(",") and template.label not in found[3]["labels"].split(",")


def test_plain_sentences(docs):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "SPDX-License-Identifier: Apache-2.0"), (3, "licensed under CC BY-NC 4.0."), (4, "the mit campus has an apache helicopter, by the way")]
    found = scanned(docs, rows)
    assert [r["labels"] for r in found] == ["gpl-3", "apache-2", "cc-by-nc", ""]
    assert [r["base_labels"] for r in found] == ["", "", "cc-by-nc", ""]


def test_own_templates(docs):
    own = (licenses.Template("house", "alpha beta gamma", base=True), licenses.Template("long", "one two three four five six", ("three four",)))
    found = scanned(docs, [(1, "x alpha beta gamma alpha beta gamma"), (2, "one two three four five seven")], templates=own)
    assert (found[0]["n_base"], found[0]["first_word"], found[0]["last_word"]) == (2, 1, 4)
    assert found[1]["labels"] == "long" and 0.6 <= found[1]["score"] < 1
    with pytest.raises(ValueError):
        licenses.build_index((licenses.Template("bad", "one two", ("two one",)),))


def test_scan_edge_rows(docs):
    long = "word " * 200_000 + "under the mit license " + "mit " * 50_000
    rows = [(1, None), (2, ""), (3, " .,; "), (4, "UNDER the MIT licenſe"), (5, "Kelvin K under the mit license"), (6, long), (7, "cc by nc"), (7, "cc by nc"), (7, "other"), (None, "under the mit license")]
    found = scanned(docs, rows)
    plain = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["base_labels"]) for r in found]
    assert plain[:3] == [(1, 0, 0, None, ""), (2, 0, 0, None, ""), (3, 0, 0, None, "")]
    assert plain[3][2:] == (0, None, "") and plain[4] == (5, 6, 1, 2, "mit")
    assert plain[5] == (6, 250_004, 1, 200_000, "mit")
    assert sorted(plain[6:9], key=str) == [(7, 1, 0, None, ""), (7, 3, 1, 0, "cc-by-nc"), (7, 3, 1, 0, "cc-by-nc")] and plain[9] == (None, 4, 1, 0, "mit")
    assert scanned(docs, []) == []


def test_scan_has_no_shuffle_and_no_python(docs):
    plan = licenses.report(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Pandas|Arrow|Join", plan)


# --- centroid clusters


def plain_clusters(rows, k, rounds, dims):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * float(x)) for x in v]))
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centers = [list(v) for _, v in seeds]
    for i in range(rounds + 1):
        told = []
        for _, v in kept:
            told.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)))
        if i < rounds:
            for j in range(len(centers)):
                mine = [v for (_, v), (_, c) in zip(kept, told) if c == j]
                if mine:
                    centers[j] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    total, per = sum(d for d, _ in told), {}
    for d, c in told:
        per[c] = per.get(c, 0) + d
    return sorted(((i, c, d, per[c], total, digest[c]) for (i, _), (d, c) in zip(kept, told)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, v int, d string")


@pytest.mark.parametrize("shape", ["groups", "even", "line", "equal"])
def test_clusters_equal_plain_version(spark, shape):
    rng = np.random.default_rng(4)
    if shape == "groups":
        v = rng.normal(size=(7, 6)).repeat(40, 0) + rng.normal(size=(280, 6)) * 0.1
    elif shape == "even":
        v = rng.uniform(-1, 1, size=(250, 6))
    elif shape == "line":
        v = np.outer(rng.integers(-20, 20, 200), np.ones(6)) / 64
    else:
        v = np.full((60, 6), -0.3)
    rows = [(i, [float(x) for x in np.float32(r)]) for i, r in enumerate(v)]
    found = centroids.cluster(frame(spark, rows), k=9, rounds=4, dims=6).collect()
    assert sorted(map(tuple, found), key=str) == plain_clusters(rows, 9, 4, 6)


def test_cluster_edge_rows(spark):
    good = [0.5, -0.25, 1.0]
    rows = [(1, good), (1, good), (1, [0.1, 0.2, 0.3]), (None, [0.4, 0.4, 0.4]), (2, None), (3, []), (4, [1.0, 2.0]), (5, [1.0, 2.0, 3.0, 4.0]), (6, [1.0, None, 2.0]), (7, [math.nan, 1.0, 1.0]), (8, [math.inf, 1.0, 1.0]), (9, [0.0, 0.0, 0.0])]
    found = centroids.cluster(frame(spark, rows), k=40, rounds=2, dims=3).collect()
    assert sorted(map(tuple, found), key=str) == plain_clusters(rows, 40, 2, 3)
    assert centroids.cluster(frame(spark, []), dims=3).collect() == []
    assert centroids.cluster(frame(spark, [(1, None)]), dims=3).collect() == []
    huge = centroids.cluster(frame(spark, [(1, [3e38, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0])]), k=1, rounds=1, dims=3).collect()
    assert len(huge) == 2 and all(0 <= r["distance"] < 1 << 62 for r in huge)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    centers = rng.integers(-300, 300, size=(40, 64))
    v = centers[rng.integers(0, 40, 3000)] + rng.integers(-25, 26, size=(3000, 64))
    simplex = centroids.Simplex.of(centers)
    squared = simplex.squared(v)
    which, distance, compared = centroids.nearest(v, squared, centers, simplex)
    all_of_them = ((v[:, None, :] - centers) ** 2).sum(2)
    assert (which == all_of_them.argmin(1)).all() and (distance == all_of_them.min(1)).all()
    assert compared < 0.2 * all_of_them.size
    x, hx = simplex.apexes(squared)
    c, hc = simplex.apexes(simplex.squared(centers))
    flat = ((x[:, None, :] - c) ** 2).sum(2)
    slack = centroids.MARGIN * all_of_them.max()
    assert (flat + (hx[:, None] - hc) ** 2 <= all_of_them + slack).all() and (flat + (hx[:, None] + hc) ** 2 >= all_of_them - slack).all()


# --- periodic runs


def plain_runs(w):
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts_with_runs():
    rng = random.Random(6)
    for t in range(240):
        n, w = rng.randrange(0, 300), []
        if t % 8 == 0:
            w = [rng.randrange(2) for _ in range(n)]
        elif t % 8 == 1:
            p = [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
            w = [p[i % len(p)] for i in range(n)]
            for _ in range(rng.randrange(4) if n else 0):
                w[rng.randrange(n)] = 9
        elif t % 8 == 2:
            w = fibonacci(n)
        elif t % 8 == 3:
            while len(w) < n:
                w += [rng.randrange(50) for _ in range(rng.randrange(1, 40))] * rng.randrange(1, 6)
        elif t % 8 == 4:
            w = ["a"] * n
        elif t % 8 == 5:
            w = (["a"] * rng.randrange(1, 30) + ["x"]) * 12
        elif t % 8 == 6:
            p = [rng.randrange(3) for _ in range(rng.randrange(1, 5))]
            while len(w) < n:
                w += p * rng.randrange(1, 9) + [rng.randrange(3)]
        else:
            w = [i.bit_count() % 2 for i in range(n)]
        yield [str(x) for x in w]


def word_hashes(w):
    return runs.hashed([x.encode() for x in w])


def test_runs_equal_plain_version():
    texts = list(texts_with_runs())
    expected = [plain_runs(w) for w in texts]
    assert sum(map(len, expected)) > 400
    assert runs.find_runs([word_hashes(w) for w in texts]) == expected
    assert runs.find_runs([word_hashes(w) for w in texts], append=100) == expected


@pytest.mark.parametrize("step", [1, 13])
def test_words_appended_in_pieces(step):
    for w in list(texts_with_runs())[:80]:
        x, catchers = word_hashes(w), runs.Catchers(len(w))
        for a in range(0, len(x), step):
            catchers.append(x[a : a + step])
        assert catchers.runs() == plain_runs(w)


@pytest.mark.parametrize("words, expected", [
    (["a"] * 400_000, [(0, 400_000, 1)]),
    ((["a"] * 3000 + ["x"]) * 100, None),
    ([str(i) for i in range(300_000)], []),
    ([str(i % 70_000) for i in range(250_000)], [(0, 250_000, 70_000)]),
])
def test_long_texts(words, expected):
    found = runs.find_runs([word_hashes(words)])[0]
    if expected is None:
        expected = sorted([(3001 * i, 3000, 1) for i in range(100)] + [(0, len(words), 3001)], key=lambda r: (r[0], r[2]))
    assert found == expected


def test_shorter_runs_are_refused():
    with pytest.raises(ValueError):
        runs.Catchers(100, least=10)


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *told, hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_run_report_equals_plain_version(docs):
    rng = random.Random(7)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts_with_runs())]
    rows += [(1000 + i, "".join(rng.choice(["alpha", "betaé", "中文", "d e", " "]) + rng.choice([" ", "\n", "\t ", "\x0b", "\x0c\r"]) for _ in range(rng.randrange(120)))) for i in range(300)]
    rows += [(-5, "x " * 30), (9_007_199_254_740_993, "y " * 30), (2000, None), (2001, ""), (2002, " \n\t"), (3, "a b"), (3, "a b"), (3, "a " * 40)]
    found = runs.report(docs(rows), planted=True).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plain_report(i, t) for i, t in rows), key=str)
    assert any(r["n_runs"] for r in found if r["doc_id"] > 999)


def test_run_report_edge_rows(docs):
    found = runs.report(docs([(None, "z " * 24), (None, None), (1, "z " * 23)]), planted=True).collect()
    told = {(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) for r in found}
    assert told == {(None, 1, 0, 24, 1, 24000), (None, 0, None, None, None, None), (1, 0, None, None, None, None)}
    assert runs.report(docs([])).collect() == []


# --- the pipeline's staged folders


def test_stages_remove_what_the_stage_before_has_staged(spark, docs, tmp_path):
    import corpus_pipeline
    from gripelode.llm import common

    made = []

    @corpus_pipeline.tidy
    def halve(spark, rows, sf_dir):
        out = common.stage(rows.where("doc_id % 2 = 0"), "half")
        made.append(Path(out._staged_at.removeprefix("file://")))
        return out

    corpus_pipeline._left.clear()
    first = halve(spark, docs([(i, "x") for i in range(8)]), "")
    first.write.parquet(str(tmp_path / "first"))
    # Documents that still come from a staged folder keep it.
    assert halve(spark, first.where("doc_id < 4"), "").count() == 2 and made[0].exists()
    # Documents that were written and read again do not.
    assert halve(spark, spark.read.parquet(str(tmp_path / "first")), "").count() == 4
    assert not made[0].exists() and not made[1].exists() and made[2].exists()
