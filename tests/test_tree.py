import random

import pytest
from pyspark.sql import functions as F

import rows
from mensura.operators import tree, versions
from mensura.plans import forecast


def gain(y, left):
    inside, outside = [v for v, go in zip(y, left) if go], [v for v, go in zip(y, left) if not go]
    if not inside or not outside:
        return None
    return sum(inside) ** 2 / len(inside) + sum(outside) ** 2 / len(outside)


def brute(data, y, numbers, texts, depth, node=1, out=None):
    """Every threshold and category of every node, one after another."""
    out = {} if out is None else out
    best = None
    if depth and len(set(y)) > 1:
        for c in numbers:
            values = sorted({r[c] for r in data})
            for a, b in zip(values, values[1:]):
                g = gain(y, [r[c] <= (a + b) / 2 for r in data])
                if best is None or g > best[0]:
                    best = (g, c, (a + b) / 2, None)
        for c in texts:
            for word in sorted({r[c] for r in data}):
                g = gain(y, [r[c] != word for r in data])
                if g is not None and (best is None or g > best[0]):
                    best = (g, c, None, word)
    if best is None:
        out[node] = ("leaf", sum(y) / len(y) / tree.SCALE)
        return out
    _, c, threshold, word = best
    out[node] = (c, threshold, word)
    left = [r[c] <= threshold if word is None else r[c] != word for r in data]
    for side, at in ((True, 2 * node), (False, 2 * node + 1)):
        keep = [i for i, go in enumerate(left) if go == side]
        brute([data[i] for i in keep], [y[i] for i in keep], numbers, texts, depth - 1, at, out)
    return out


def stored(df):
    return forecast.stored("tree", df)


@pytest.mark.parametrize(("seed", "panes"), [(1, 4), (2, 16), (3, 256)])
def test_tree_equals_brute_force(spark, seed, panes):
    """Smooth and coarse numbers, a constant, missing ones, texts; labels that follow some of them."""
    rng = random.Random(seed)
    data = []
    for _ in range(220):
        a, b = round(rng.uniform(-5, 5), 6), float(rng.randrange(4))
        word = rng.choice(["u", "v", "w", None])
        label = round(a * a + (7 if word == "v" else 0) + b + rng.gauss(0, 1), 2)
        data.append((label, a, b if rng.random() < 0.8 else None, 1.0, None, rng.choice([None, round(rng.random(), 3)]), word))
    names = ["a", "b", "same", "none", "c"]
    df = spark.createDataFrame(data, "label double, a double, b double, same double, none double, c double, word string").repartition(3)
    fill = {"a": 0.0, "b": 1.0, "same": 1.0, "none": None, "c": 0.5}
    model = tree.grow(df, "label", names, ["word"], fill, "__NA__", 4, stored, panes)
    used = [n for n in names if fill[n] is not None]
    flat = [{**{c: v if v is not None else fill[c] for c, v in zip(names, r[1:6])}, "word": r[6] or "__NA__"} for r in data]
    want = brute(flat, [round(r[0] * tree.SCALE) for r in data], used, ["word"], 4)
    got = {n: (s.feature, s.threshold, s.category) for n, s in model.splits.items()} | {n: ("leaf", v) for n, v in model.leaves.items()}
    assert got == want
    assert tree.Tree.from_json(model.to_json()) == model
    odd = df.limit(5).withColumn("word", F.lit("never seen")).withColumn("a", F.lit(None).cast("double"))
    assert odd.select(model.predict().alias("p")).filter("p is null").count() == 0


def test_ties_and_pure_nodes(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0, "x"), (1.0, 2.0, 6.0, "x"), (3.0, 3.0, 7.0, "y"), (3.0, 4.0, 8.0, "y")], "label double, a double, b double, t string")
    model = tree.grow(df, "label", ["a", "b"], ["t"], {"a": 0.0, "b": 0.0}, "", 4, stored)
    assert model.splits == {1: tree.Split("a", 2.5, None)} and model.leaves == {2: 1.0, 3: 3.0}
    same = tree.grow(df.withColumn("label", F.lit(2.0)), "label", ["a"], [], {"a": 0.0}, "", 4, stored)
    assert same.splits == {} and same.leaves == {1: 2.0}
    by_word = tree.grow(df.drop("a", "b"), "label", [], ["t"], {}, "", 2, stored)
    assert by_word.splits[1].category == "x" and by_word.leaves == {2: 3.0, 3: 1.0}


def test_rows_are_never_the_copied_side_of_a_join(spark, monkeypatch):
    """The unfolded cells look as small as their file; only the panes may be broadcast."""
    plans, best = [], tree._best
    monkeypatch.setattr(tree, "_best", lambda df: plans.append(rows.formatted_plan(df)) or best(df))
    monkeypatch.setattr(type(spark.range(1)), "approxQuantile", None)  # its sketches would go to the driver, one for each task
    df = spark.createDataFrame([(float(i % 7), float(i)) for i in range(60)], "label double, a double").repartition(3)
    model = tree.grow(df, "label", ["a"], [], {"a": 0.0}, "", 1, stored, 4)
    assert model.splits and len(plans) == 2
    joins = [line for line in plans[1].splitlines() if "BroadcastHashJoin Inner" in line]
    assert any("BuildRight" in line for line in joins)
    lines = plans[1].splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line and ":" in line:
            deeper = []
            for below in lines[i + 1 :]:
                if len(below) - len(below.lstrip(" :+-")) <= len(line) - len(line.lstrip(" :+-")):
                    break
                deeper.append(below)
            assert not any("Generate" in below for below in deeper)


def test_two_promotions_in_one_moment(spark, tmp_path, monkeypatch):
    """Both runs saw no model in use; the second one to write is refused and its forecasts are not written."""
    root = str(tmp_path / "promotions")
    real = versions._last
    monkeypatch.setattr(versions, "_last", lambda *_: None)
    versions.publish(spark, root, "one", None)
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, root, "two", None)
    monkeypatch.setattr(versions, "_last", real)
    assert versions.current(spark, root) == "one" and rows.as_dicts(versions.log(spark, root), "run_id").keys() == {"one"}
