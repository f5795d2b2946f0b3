import json
import random

from gripelode.sources import payloads


def walk(root):
    """Objects of a value, parents first and the last child before its siblings."""
    waiting = [(0, root)]
    while waiting:
        depth, node = waiting.pop()
        if isinstance(node, dict):
            yield depth, node
        if isinstance(node, (dict, list)):
            waiting.extend((depth + 1, child) for child in (node.values() if isinstance(node, dict) else node))


def frame(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "id int, body string")


def walked(spark, bodies):
    found = {}
    for r in payloads.json_objects(frame(spark, bodies)).orderBy("id", "pos").collect():
        found.setdefault(r["id"], []).append((r["pos"], r["depth"], json.loads(r["object"])))
    return found


def random_value(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.25:
        return rng.choice([None, True, 1, 2.5, "text", "", '{"a": 1}', "[1]", '"', "é😀\n", {}, []])
    if kind < 0.65:
        names = rng.sample(["z", "b", "a", "Ab", "é", "node", "10", "9", " ", '"', "a.b"], rng.randrange(1, 5))
        return {n: random_value(rng, depth - 1) for n in names}
    return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]


def test_objects_equal_plain_walk(spark):
    rng = random.Random(4)
    values = [random_value(rng, rng.randrange(6)) for _ in range(300)]
    bodies = [rng.choice([json.dumps, lambda v: "  \n" + json.dumps(v, ensure_ascii=False, indent=1)])(v) for v in values]
    expected = {i: [(p, d, o) for p, (d, o) in enumerate(walk(v))] for i, v in enumerate(values)}
    got = walked(spark, bodies)
    assert got == {i: e for i, e in expected.items() if e}
    # The order of names is the document's.
    assert all(list(o) == list(e[2]) for i in got for (_, _, o), e in zip(got[i], expected[i]))


def test_deep_bodies_and_repeated_payloads(spark):
    deep = '{"a":' * 60 + "{}" + "}" * 60
    got = payloads.json_objects(frame(spark, [deep]).unionAll(frame(spark, [deep]))).collect()
    assert sorted(r["pos"] for r in got) == sorted([*range(61), *range(61)])
    assert {r["pos"]: r["depth"] for r in got} == {i: i for i in range(61)}


def test_unreadable_bodies_are_listed(spark):
    bodies = ['{"a": 1}', "{", None, " ", "[" * 5000 + "]" * 5000, '{"a": 1, "a": {}}', "[]", "7", "hello"]
    assert set(walked(spark, bodies)) == {0}
    reasons = {r["id"]: r["reason"] for r in payloads.unreadable(frame(spark, bodies)).collect()}
    assert set(reasons) == {1, 2, 3, 4, 5, 8}
    assert reasons[2] == reasons[3] == "empty" and "deeper" in reasons[4] and "twice" in reasons[5] and reasons[1] == reasons[8] == "no JSON"


def test_no_python_in_the_plan(spark):
    plan = payloads.json_objects(frame(spark, ['{"a": {}}']))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
