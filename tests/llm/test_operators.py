"""Operators against plain versions, and the cases that tables may hold: nulls, empty and long texts, ties, repeated rows."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gripelode.llm import common, decontaminate, embeddings, jaccard, lines, lm, packing, sentencepiece_codec, toxicity, urls, warc, words

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("broadcast_rows", [0, common.BROADCAST_ROWS])
def test_components(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2040)]
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    expected = smallest_reachable(nodes, [p for p in links if p[0] != p[1]])
    found = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == expected


def test_further_links_join_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    further = [(rng.randrange(260), rng.randrange(260)) for _ in range(60)] + [links[0], (300, 301), (7, 7)]
    both = [p for p in links + further if p[0] != p[1]]
    roots = common.components(spark.createDataFrame(links, "a long, b long"))
    found = common.joined_roots(roots, spark.createDataFrame(further, "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == smallest_reachable({x for p in both for x in p}, both)
    assert common.joined_roots(roots, spark.createDataFrame(links, "a long, b long")) is roots


def family(rng, n, changes, size=120):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(size), rng.randrange(changes)):
            w[at] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w[rng.randrange(3) : size - rng.randrange(20)]))
    return out


@pytest.mark.parametrize("paired", [0, jaccard.PAIRED])  # with 0 no group gives its pairs before the last round
def test_jaccard_equals_brute_force(docs, monkeypatch, paired):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    rng = random.Random(1)
    texts = family(rng, 90, 4) + family(rng, 60, 30) + family(rng, 25, 3, 9) + family(rng, 12, 2, 6)
    texts += [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts += [None, "", " \n\t", "one two", "ONE  two", "one two three four five", texts[0], texts[0].upper(), "same " * 400, "same " * 300, "x " * 20_000 + "y"]
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    expected = smallest_reachable(range(len(texts)), links)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(docs(enumerate(texts))).collect()}
    assert found == {i: (len(sets[i]), expected[i]) for i in range(len(texts))}
    assert len(links) > 100


def test_jaccard_keeps_odd_rows(docs):
    found = jaccard.classes(docs([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "")])).collect()
    assert Counter((r["doc_id"], r["component_id"], r["n_copies"]) for r in found) == {(None, 5, 3): 1, (5, 5, 3): 2, (7, 7, 1): 1}
    assert jaccard.classes(docs([])).count() == 0

def test_near_copies_make_rows_in_proportion(docs, monkeypatch):
    made, stage = Counter(), common.stage

    def counted(df, name):
        out = stage(df, name)
        made[name.rstrip("0123456789")] += out.count()
        return out

    monkeypatch.setattr(common, "stage", counted)
    rng = random.Random(4)
    texts = family(rng, 200, 10) + family(rng, 200, 30)
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    found = {r["doc_id"]: r["component_id"] for r in jaccard.classes(docs(enumerate(texts))).collect()}
    assert found == smallest_reachable(range(len(texts)), links) and len(links) > 300
    assert max(n for name, n in made.items() if name not in ("pairs", "candidates")) <= 5 * len(texts), made  # those two: cold blocks, held by at most COLD sets


def test_holders_of_a_block_meet_in_few_groups(spark):
    rng = random.Random(8)
    held = {n: sorted({rng.randrange(30) + 20 * (n % 4) for _ in range(rng.randrange(1, 12))}) for n in range(200)}
    rows = jaccard._groups(spark.createDataFrame([(n, keys) for n, keys in held.items()], "node long, keys array<long>")).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r["node"]].add(r["gid"])
    assert len(rows) == sum(map(len, groups.values())) and all(g in groups[g] for r in rows for g in [r["gid"]])
    assert all(groups[a] & groups[b] for a, b in itertools.combinations(held, 2) if set(held[a]) & set(held[b]))
    assert len(rows) < sum(map(len, held.values())) / 2


def test_tiles_join_what_links():
    rng = np.random.default_rng(6)
    base = rng.choice(1 << 40, 90, replace=False).astype(np.uint64)
    sets = [np.sort(np.concatenate((rng.choice(base, 90 - k % 14, replace=False), rng.choice(1 << 40, k % 9).astype(np.uint64)))) for k in range(70)]
    roots = np.arange(70) // 3
    linked = [(i, j) for i, j in itertools.combinations(range(70), 2) if 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]))]
    known = [(i, 3 * (i // 3)) for i in range(70)]
    for block, columns in ((jaccard.BLOCK, jaccard.COLUMNS), (16, 7)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(jaccard, "BLOCK", block)
            m.setattr(jaccard, "COLUMNS", columns)
            found = jaccard.linked_sets(sets, roots, 80)
        assert set(map(tuple, map(sorted, found))) <= set(linked) and len(found) < 70
        same = lambda pairs: smallest_reachable(range(70), [p for p in known + pairs if p[0] != p[1]])
        assert same(found) == same(linked)
    assert jaccard.linked_sets([base, base[:1]], np.arange(2), 80) == []


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    for size, gone in ((40, 4), (300, 30), (2000, 200)):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = a[gone:]
        both = list(jaccard.block_keys(np.concatenate((a, b)), np.array([len(a), len(b)]), 80))
        keys = [{k for who, key, _ in both for k in key[who == i].tolist()} for i in (0, 1)]
        assert keys[0] & keys[1]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=16) * 0.18)], i % 3) for i in range(150)]
    rows += [(200 + k, rows[k % 2][1], rows[k % 2][2]) for k in range(6)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] + [1.0] * 15, 1), (303, [None] + [1.0] * 15, 1), (304, rows[0][1], None), (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (307, [], 1), (308, [float("inf")] * 16, 1)]
    good = [r for r in rows if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links = []
    for a, b in itertools.combinations(good, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = np.array(a[1], float), np.array(b[1], float)
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.append((a[0], b[0]))
    roots, degree = smallest_reachable([r[0] for r in rows], links), Counter(x for pair in links for x in pair)
    found = embeddings.near_duplicates(vectors(spark, rows), tile=16).collect()
    assert {r["vec_id"]: tuple(r)[1:] for r in found} == {i: (degree[i], roots[i], roots[i] == i) for i, _, _ in rows}
    assert len(links) > 100
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(200, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q, scale, error = embeddings.quantise(unit)
    approx = (q * scale[:, None]) @ (q * scale[:, None]).T
    assert (np.abs(approx - unit @ unit.T) <= error[:, None] + error[None, :] + error[:, None] * error[None, :]).all()


def test_leaks_are_found_and_clean_texts_stay(spark, docs):
    rng = random.Random(8)
    item = lambda n: " ".join(f"b{rng.randrange(10**5)}" for _ in range(n))
    noise = lambda n: " ".join(f"n{rng.randrange(500)}" for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([15, 23, 35, 48, 57, 3, 300])]
    long = items[4][1].split()
    long[30] = "changed"
    texts = {i: f"{noise(200)} {t.upper()}\n{noise(100)}" for i, t in items}
    texts |= {10: noise(300), 11: None, 12: "", 13: items[2][1][: len(items[2][1]) // 2], 14: f"{noise(9)} {' '.join(long)} {noise(9)}", 15: items[1][1], 16: f"{items[0][1]} {items[1][1]}"}
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (None, "x y")], "item_id long, text string")
    found = decontaminate.leaks(docs(texts.items()), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i, _ in items} | {(14, 4), (15, 1), (16, 0), (16, 1)}
    assert all(r["similarity"] == 1 for r in found if r["doc_id"] != 14)
    left = decontaminate.without_leaks(docs([*texts.items(), (None, items[0][1])]), benchmark)
    assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == [10, 11, 12, 13] and left.where("doc_id is null").count() == 1
    assert decontaminate.leaks(docs([]), benchmark).count() == 0
    assert decontaminate.leaks(docs(texts.items()), benchmark.where("false")).count() == 0


def brute_force(item, text, size=5):
    """The largest Jaccard similarity of the item's shingle counts and those of any passage of the text."""
    size = min(size, len(item))
    own, runs = Counter(tuple(item[i : i + size]) for i in range(len(item) - size + 1)), [tuple(text[i : i + size]) for i in range(len(text) - size + 1)]
    best, total = 0.0, own.total()
    for i in (i for i, r in enumerate(runs) if r in own):
        seen, both = Counter(), 0
        for j in range(i, min(len(runs), i + len(item) * 5 // 4)):
            seen[runs[j]] += 1
            both += seen[runs[j]] <= own[runs[j]]
            best = max(best, both / (total + j - i + 1 - both))
    return best


@pytest.mark.parametrize("n", [100, 142, 227, 363])
def test_leaks_equal_brute_force_on_changed_runs(n):
    rng = random.Random(n)
    word = lambda: f"w{rng.randrange(5000)}"
    benchmark = [[word() for _ in range(n)] for _ in range(4)]
    texts, expected = [], {}
    for k, item in enumerate(benchmark):
        for kind in ("replaced", "inserted", "deleted", "scattered"):
            for share in (0.02, 0.05, 0.09, 0.13):
                run, at = max(1, int(n * share)), rng.randrange(n // 4, n // 2)
                new = [word() for _ in range(0 if kind == "deleted" else run)]
                copy = item[:at] + new + item[at + (0 if kind == "inserted" else run) :]
                if kind == "scattered":
                    copy = [word() if i % max(1, n // (run // 5 + 1)) == n // 7 else w for i, w in enumerate(item)]
                text = [word() for _ in range(30)] + copy + [word() for _ in range(30)]
                if (s := brute_force(item, text)) >= 0.8:
                    expected[len(texts), k] = s
                texts.append(" ".join(text))
    hashed, offsets = next(words.words([" ".join(b) for b in benchmark]))[1:]
    items = decontaminate.Items([[k] for k in range(len(benchmark))], np.split(hashed, offsets[1:-1]), [{}] * len(benchmark), 5, 80)
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for b in decontaminate._search(items)([batch]) for r in b.to_pylist()}
    assert len(expected) > 20 and found == pytest.approx(expected)


@pytest.mark.parametrize("part_words", [40, decontaminate.PART_WORDS])
def test_repeated_items_weigh_as_single_ones(spark, docs, monkeypatch, part_words):
    monkeypatch.setattr(decontaminate, "PART_WORDS", part_words)
    make = lambda name, n: [f"{name}{i}" for i in range(n)]
    twice, tenfold, framed = make("a", 50), make("b", 30), make("frame", 40)
    rows = [(i, twice) for i in (0, 1)] + [(i, tenfold) for i in range(10, 20)] + [(i, framed + make(f"own{i}_", 10)) for i in range(20, 30)]
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "item_id long, text string")
    found = decontaminate.leaks(docs([(1, " ".join([*twice[:25], "new", *twice[26:]])), (2, " ".join([*tenfold[:-1], "new"])), (3, " ".join(["new", *framed[1:], *make("own20_", 10)]))]), benchmark).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    whole = 36 * 0.1 + 10  # the best passages leave a changed word at their end out
    assert found == pytest.approx({(1, i): 41 / 51 for i in (0, 1)} | {(2, i): 25 / 26 for i in range(10, 20)} | {(3, 20): (whole - 0.1) / whole})


def test_block_tables_find_all_prints_within_the_radius():
    rng = np.random.default_rng(6)
    wanted = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 10), replace=False)) for _ in range(2000)], np.uint64)
    prints = wanted[np.arange(2000) % 20] ^ flips
    tables = [decontaminate.near_values((wanted >> np.uint64(16 * b)) & np.uint64(0xFFFF), decontaminate.RADIUS // 4) for b in range(4)]
    at, which, _ = decontaminate.near_prints(prints, wanted, tables)
    expected = {(i, j) for i in range(2000) for j in range(20) if bin(int(prints[i] ^ wanted[j])).count("1") <= decontaminate.RADIUS}
    assert set(zip(at.tolist(), which.tolist())) == expected


def test_fingerprints_equal_plain_counts():
    hashed = np.random.default_rng(7).integers(0, 1 << 63, 700).astype(np.uint64)
    for w, prints in decontaminate.fingerprints(hashed, [5, 40, 300]).items():
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
        for at in (0, 17, len(hashed) - w):
            assert (np.unpackbits(prints[at : at + 1].view(np.uint8)) == (bits[at : at + w].sum(0) > w // 2)).all()


def test_archives_round_trip(spark):
    import base64
    import hashlib

    big = "ü" * 3_000_000
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n\r\nContent-Length: 7\r\n"), (6, "u", big), (7, "u", "ends\r\n\r\n"), (None, "u", "gone")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string").repartition(3)
    found = {r["page_id"]: tuple(r)[1:] for r in warc.archive(pages).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {2: 1, 4: 3}
    assert found == {i: (len((t or "").encode()), digest(t), "revisit" if i in first else "response", first.get(i)) for i, _, t in rows if i}
    assert warc.archive(pages.where("false")).count() == 0
    folder = common.new_folder(spark, "warc")
    warc.write(pages, folder, min_bytes=1)
    index = warc.index(spark, folder)
    assert {r["record_id"] for r in index.where("record_type = 'revisit'").collect()} == {2}
    some = {bytes(r["payload"]).decode() for r in warc.read(index.where("record_id in (1, 5, 6)")).collect()}
    assert some == {"same", rows[4][2], big}


def test_url_lists_hold_from_their_dates(spark):
    entries = spark.createDataFrame([("l", "a.example", "block", "2024-01-02"), ("l", "a.example", "remove", "2024-01-04"), ("l", "ok.a.example", "allow", "2024-01-02"), ("m", "a.example/bad", "block", "2024-01-01"), ("m", None, "block", "2024-01-01"), ("m", "b.example", "what", "2024-01-01")], "list string, pattern string, action string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = [(1, "http://A.example./x", "2024-01-01"), (2, "http://a.example/x", "2024-01-02"), (3, "https://u:p@ok.a.example:80/x", "2024-01-03"), (4, "http://www.a.example/", "2024-01-03 23:59:59"), (5, "http://a.example/x", "2024-01-04"), (6, "http://a.example/bad/y?q", "2024-02-01"), (7, "http://a.example/badly", "2024-02-01"), (8, None, "2024-01-03"), (9, "nothing", "2024-01-03"), (10, "http://a.example/", None), (10, "http://a.example/", None)]
    captures = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, fetched_at string, host string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    found = [(r["page_id"], r["blocked"], r["blocked_by"]) for r in urls.decide(captures, entries).collect()]
    assert sorted(found) == [(i, i in (2, 4, 6), {2: "l", 4: "l", 6: "m"}.get(i, "")) for i in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]]
    assert urls.decide(captures.where("false"), entries).count() == 0
    assert not any(r["blocked"] for r in urls.decide(captures, entries.where("false")).collect())


def test_url_paths_keep_their_case(spark):
    entries = spark.createDataFrame([("l", "A.example/Foo", "block", "2024-01-01"), ("m", "a.example/bar", "block", "2024-01-01")], "list string, pattern string, action string, ts string")
    rows = [(1, "http://a.example/Foo"), (2, "http://a.Example/Foo/x"), (3, "http://a.example/foo"), (4, "http://a.example/Bar"), (5, "http://a.example/bar")]
    captures = spark.createDataFrame(rows, "page_id long, url string").withColumn("fetched_at", F.lit("2024-01-02"))
    assert {r["page_id"]: r["blocked_by"] for r in urls.decide(captures, entries).collect()} == {1: "l", 2: "l", 3: "", 4: "", 5: "m"}


def test_lines_stay_in_the_last_document(docs):
    import hashlib

    hot, other = "The same long line that very many documents hold here", "Another long line, É, which only four documents do hold"
    texts = {i: f"own line {i} with enough characters to count as long\n  {hot.upper() if i % 2 else hot}\t\nx\n{hot}" for i in range(6)}
    texts |= {10 + i: other for i in range(4)} | {20: None, 21: "", 22: "\n" * 200 + "x", 23: (hot + "\n") * 3, 24: hot + "!"}
    held = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(str.maketrans(UPPER, UPPER.lower()))
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    expected = {}
    for i, t in texts.items():
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and i < max(held[key(x)]))]
        expected[i] = (len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    found = {r["doc_id"]: tuple(r)[1:] for r in lines.report(docs(texts.items())).collect()}
    assert found == expected and sum(v[1] for v in expected.values()) == 12
    cleaned = lines.deduplicated(docs([*texts.items(), (None, hot)]))
    assert cleaned.columns == docs([]).columns and cleaned.where("doc_id is null").first()["text"] == hot
    assert lines.report(docs([])).count() == 0


ODD_TEXTS = ["", "  Hello   world ", "a\tb\r\nc", "ﬁ é ① 日本😀\x00", " " * 37 + "x", "<s>hi</s><0x0A><unk>", "a" * 700, "x" * 90 + " " * 50 + "né" * 80, "def f(x):\n        return x  + 1", "3.14159 https://a.example/?q=1&x=y"]


def test_texts_that_share_an_id_lose_their_own_lines(docs):
    rows = [(7, "shared long line\nx"), (7, "own text\ny"), (8, "shared long line")]
    found = lines.deduplicated(docs(rows), min_chars=5, min_docs=2).collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == [(7, "own text\ny"), (7, "x"), (8, "shared long line")]
    assert sorted((r["doc_id"], r["n_dropped"]) for r in lines.report(docs(rows), min_chars=5, min_docs=2).collect()) == [(7, 0), (7, 1), (8, 0)]


def test_pieces_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    model = open(sentencepiece_codec.MODEL, "rb").read()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), sentencepiece_codec.Codec(sentencepiece_codec.Pieces(model))
    rng = random.Random(1)
    texts = ODD_TEXTS + ["".join(rng.choice("ab cdeéñ   thinger\n.,") for _ in range(200)) for _ in range(100)]
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
    assert [own.decode(x) for x in own.encode(texts)] == texts
    assert own.decode(own.encode(["a▁b"])[0]) == "a b"


def test_long_texts_without_blanks_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    model = open(sentencepiece_codec.MODEL, "rb").read()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), sentencepiece_codec.Codec(sentencepiece_codec.Pieces(model))
    rng = random.Random(8)
    made = {
        "letters": "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(30_000)), "one": "a" * 40_000, "dashes": "-=" * 20_000,
        "ideographs": "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(20_000)), "code": "function(a,b){return a.length>b?this.name:null;}" * 800,
        "words": "".join(rng.choice(["the", "ing", "tion", "é", "日", "under", "stand"]) for _ in range(9_000)), "border": "ab" * (sentencepiece_codec.STRETCH // 2 + 5),
    }
    texts = [*made.values(), *("x" * n for n in range(60, 70)), *(f"{i}" * 90 for i in range(50)), "short " * 10 + made["code"][:900] + " end"]
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)


def test_a_very_long_text_takes_time_in_proportion():
    model = open(sentencepiece_codec.MODEL, "rb").read()
    own = sentencepiece_codec.Codec(sentencepiece_codec.Pieces(model))
    rng = random.Random(9)
    begin = time.perf_counter()
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(300_000)), "b" * 300_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(300_000))):
        assert own.decode(own.encode([text])[0]) == text
    assert time.perf_counter() - begin < 60


def test_unigram_search_is_the_best_path():
    class Small(sentencepiece_codec.Pieces):
        def __init__(self, scores):
            names = list(scores)
            self.unigram, self.unk, self.has_bytes = True, len(names), False
            self.longest, self.score, self.unknown_score = max(map(len, names)), np.array([*scores.values(), 0.0]), -20.0
            self._fill(names, np.arange(len(names), dtype=np.int32))

    rng = random.Random(2)
    scores = {"".join(p): -rng.uniform(1, 9) for n in (1, 2, 3) for p in itertools.product("▁ab", repeat=n) if "▁" not in p[1:]}
    names = list(scores)
    codec = sentencepiece_codec.Codec(Small(scores))
    for text in ["abba", "aab bab", "b", "abababab aaa", "ac", "abc" * 40, "bca" * 30 + "a" * 100]:
        ids = codec.encode([text])[0].tolist()
        full, best = "▁" + text.replace(" ", "▁"), {0: 0.0}
        for end in range(1, len(full) + 1):
            best[end] = max(best[end - k] + scores.get(full[end - k : end], -20.0 if k == 1 else -math.inf) for k in (1, 2, 3) if end >= k)
        assert sum(scores[names[i]] if i < len(names) else -20.0 for i in ids) == pytest.approx(best[len(full)])


def test_encoded_tables(docs):
    rows = [(1, "some text"), (1, "some text"), (None, "x"), (3, None), (4, "")]
    found = sentencepiece_codec.encode(docs(rows), check=True).collect()
    assert all(r["round_trip"] for r in found) and sum(r["n_tokens"] == 0 for r in found) == 2 and len(found) == 5
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs(rows)))
    assert Counter(r["text"] for r in back.collect()) == {"some text": 2, "x": 1, "": 2}
    assert sentencepiece_codec.encode(docs([])).count() == 0


def test_packing_is_lossless(docs):
    rng = random.Random(4)
    texts = {i: " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(120))) for i in range(60)} | {100: None, 101: "", 102: "long " * 3000}
    rows = packing.packed(docs(texts.items()), row=64, group_tokens=2000)
    encoding = packing._encoding(open(packing.RANKS, "rb").read())
    parts = defaultdict(dict)
    for r in packing.unpacked(rows).collect():
        parts[r["doc_id"]][r["offset"]] = r["ids"]
    joined = {i: [x for at in sorted(p) for x in p[at]] for i, p in parts.items()}
    assert joined == {i: [*encoding.encode_ordinary(t or ""), packing.END_ID] for i, t in texts.items()}
    for r in rows.collect():
        bounds = np.array(r["cu_seqlens"])
        at = packing.positions(bounds)
        assert bounds[-1] == r["n_tokens"] <= 64 and len(r["ids"]) == 128 and (at[bounds[:-1]] == 0).all() and (np.diff(at)[np.diff(at) != 1] <= 0).all()
    assert packing.packed(docs([])).count() == 0


def test_written_matrices_are_read_back(docs, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(150)))) for i in range(80)] + [(None, "no id"), (3, None), (3, ""), (90, "long " * 700)]
    index = packing.write(docs(rows), f"file://{tmp_path}/packed", row=64, group_tokens=3000)
    lines = {(r["file"], r["line"]): r for r in index.collect()}
    encoding = packing._encoding(open(packing.RANKS, "rb").read())
    parts = defaultdict(list)
    found = packing.read(index, row=64).collect()
    assert {(r["file"], r["line"]) for r in found} == set(lines) and len(found) == len(lines)
    for r in found:
        at = lines[r["file"], r["line"]]
        assert r["cu_seqlens"] == at["cu_seqlens"] and len(r["ids"]) == len(r["positions"]) == 64
        for doc, offset, a, b in zip(at["doc_ids"], at["doc_offsets"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:]):
            assert r["positions"][a:b] == list(range(b - a))
            parts[doc].append((offset, r["ids"][a:b]))
        assert set(r["ids"][at["n_tokens"] :]) <= {packing.END_ID} and set(r["positions"][at["n_tokens"] :]) <= {0}
    expected = defaultdict(list)
    for i, text in rows:
        ids = [*encoding.encode_ordinary(text or ""), packing.END_ID]
        expected[i] += [(at, ids[at : at + 64]) for at in range(0, len(ids), 64)]
    assert {i: sorted(p) for i, p in parts.items()} == {i: sorted(p) for i, p in expected.items()}
    told = {r["file"].rsplit("/", 1)[1]: r for r in packing.files(index, row=64).collect()}
    sizes = Counter()
    for path in (tmp_path / "packed").iterdir():
        sizes[path.stem] += path.stat().st_size
    assert sizes == {name: r["n_bytes"] for name, r in told.items()} and sum(r["n_lines"] for r in told.values()) == len(lines)
    assert packing.write(docs([])).count() == 0


def test_null_id_rows_keep_near_links(docs):
    words = [f"w{i}" for i in range(60)]
    near = [*words[:-1], "other"]
    nearer = [*words[:-2], "more", "other"]
    rows = [(None, " ".join(near)), (1, " ".join(words)), (2, "quite another text of some words"), (5, " ".join(nearer))]
    found = {r["doc_id"]: r["component_id"] for r in jaccard.classes(docs(rows)).collect()}
    assert found == {None: 1, 1: 1, 2: 2, 5: 1}


def test_best_fit_takes_the_fullest_row():
    rng = random.Random(9)
    lengths = [rng.randrange(1, 101) for _ in range(400)]
    left, expected = [], []
    for i in sorted(range(400), key=lambda i: (-lengths[i], i)):
        room = [c for c in left if c >= lengths[i]]
        if room:
            left[left.index(min(room))] -= lengths[i]
        else:
            left.append(100 - lengths[i])
    rows = packing.best_fit_decreasing(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in r) for r in rows) == sorted(left) and sorted(i for r in rows for i in r) == list(range(400))


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    examples = []
    for i in range(500):
        term = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.uniform(0.1, 1, len(term))
        examples.append((i, int(rng.integers(2)), term, w / np.linalg.norm(w)))
    index = toxicity.Index(40, examples)
    for _, _, term, w in examples[:40]:
        which, cosine = index.nearest(term, w, 10)
        plain = (index.weights[term].T @ w.astype(np.float32))[:500]
        best = np.lexsort((np.arange(500), -plain))[:10]
        assert np.allclose(np.sort(cosine), np.sort(plain[best][plain[best] > 0]), atol=1e-6)


def test_toxicity_learns_and_keeps_clean_texts(spark, docs):
    rng = random.Random(5)
    noise = lambda: " ".join(f"n{rng.randrange(300)}" for _ in range(60))
    rows = [(i, f"{noise()} {'idiot moron' if i % 4 == 0 else ''} {noise()}") for i in range(400)] + [(900, None), (901, ""), (None, "idiot")]
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)] + [(1, 0, None), (None, 0, 1), (5000, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score(docs(rows), labels).collect()}
    assert len(found) == 403 and all(0 <= r["score"] <= 1 for r in found.values())
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert sum(found[i]["predicted"] == (i % 4 == 0) for i in range(400) if found[i]["held_out"]) >= 0.95 * sum(found[i]["held_out"] for i in range(400))
    assert found[900]["predicted"] == found[901]["predicted"] == 0
    assert {r["score"] for r in toxicity.score(docs(rows[:3]), labels.where("false")).collect()} == {0.5}
    assert toxicity.score(docs([]), labels).count() == 0


def test_rare_toxic_words_count_beside_thousands_of_others(spark, docs):
    rng = random.Random(8)
    noise = lambda: " ".join(f"n{rng.randrange(300)}" for _ in range(20))
    toxic = [f"{i:04d}vileword" for i in range(700)]  # 2,800 features, each in more documents than the rare word
    texts = [noise() if i % 4 else f"{noise()} {' '.join(rng.sample(toxic, 60))}" if i % 80 else f"{noise()} rareword" for i in range(1600)]
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(1600)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs([*enumerate(texts), *((i, f"{noise()} rareword") for i in range(5000, 5010)), *((i, noise()) for i in range(6000, 6010))]), labels).collect()}
    assert [found[i] for i in range(5000, 5010)] == [1] * 10 and [found[i] for i in range(6000, 6010)] == [0] * 10


def test_language_model_equals_plain_counts(docs):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(80))).upper()) for i in range(120)] + [(200, None), (201, "never seen"), (202, " \n")]
    found = {r["doc_id"]: r for r in lm.held_out_scores(docs(rows)).collect()}
    tokens = {i: [*words_of(t), "</s>"] for i, t in rows}
    trained = [tokens[i] for i in tokens if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for t in trained for w in t)
    pairs = Counter(p for t in trained for p in zip(["<s>", *t], t))
    n, v, begins, kinds, ends = sum(count.values()), len(count), Counter(), defaultdict(Counter), Counter()
    for (a, b), k in pairs.items():
        begins[a] += k
        kinds[a][min(k, 3)] += 1
        ends[b] += 1
    of = lambda c: lm.discounts(*(sum(x == k for x in c.values()) for k in (1, 2, 3, 4)))
    d, e = of(pairs), of(ends)
    rest = sum(e[min(k, 3)] for k in ends.values()) / len(pairs)
    lower = lambda w: max(ends[w] - e[min(ends[w], 3)], 0) / len(pairs) + rest / (v + 1)

    def p(a, b):
        if not begins[a]:
            return lower(b)
        return max(pairs[a, b] - d[min(pairs[a, b], 3)], 0) / begins[a] + sum(d[k] * kinds[a][k] for k in kinds[a]) / begins[a] * lower(b)

    for i, t in tokens.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in count for w in t), n)
        assert r["score"] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *t], t)))
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
    assert sum(p("w1", w) for w in count) + p("w1", "unknown") == pytest.approx(1)
    assert lm.held_out_scores(docs([])).count() == 0


def test_pipeline_on_a_small_table(spark, docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    noise = lambda n=80: " ".join(f"n{rng.randrange(3000)}" for _ in range(n))
    line = "a line that many of these documents hold, long enough to count"
    item = " ".join(f"b{k}" for k in range(30))
    texts = {i: f"{noise()}\n{line if i < 12 else ''}" + (" idiot moron scum" if i % 5 == 0 else "") for i in range(200)}
    texts |= {300: texts[51], 301: texts[52] + " more", 302: f"{noise()} {item} {noise()}", 303: None, 304: ""}
    toxic = [i for i in range(200) if i % 5 == 0]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs(texts.items()).select(columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = common.stage(stage(spark, rows, str(tmp_path)), "test")
        assert rows.columns == columns
    found = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == set(texts) - set(toxic) - {300, 301, 302}
    assert sum(line in (r["text"] or "") for r in rows.collect()) == 1
