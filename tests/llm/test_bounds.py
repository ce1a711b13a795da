"""What passes the driver at once, and work per token."""
import numpy as np
from pyspark.sql import functions as F

from keepwise.llm import components, decontamination, near_dup, toxicity


def test_toxicity_sample_comes_to_the_driver_in_pieces(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"good word{i} stays" if i % 2 else f"bad word{i} goes") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    whole = toxicity.fit_toxicity(docs, labels, bits=8)
    sizes, frame = [], type(docs)
    to_arrow = frame.toArrow

    def noted(df):
        out = to_arrow(df)
        sizes.append(out.num_rows)
        return out

    monkeypatch.setattr(toxicity, "_PIECE", 7, raising=False)
    monkeypatch.setattr(frame, "toArrow", noted)
    model = toxicity.fit_toxicity(docs, labels, bits=8)
    assert sum(sizes) == 40 and max(sizes) <= 7
    assert model.bias == whole.bias and np.array_equal(model.slots, whole.slots)
    one_class = toxicity.fit_toxicity(docs, labels.withColumn("toxic", F.lit(1)), bits=8)
    assert not one_class.slots.any() and not toxicity.fit_toxicity(docs.limit(0), labels, bits=8).slots.any()


def test_runs_are_hashed_from_their_parts(spark):
    words = ["a b c a b c d e f g h a b c d e f g h i", "a b", "", "x y z a b c"]
    hashed = decontamination._hashed(spark.createDataFrame(list(enumerate(words)), "id long, text string"))
    lengths = [1, 3, 5, 6, 7, 8]
    runs = decontamination._with_runs(hashed, lengths)
    assert set(runs.columns) == {*hashed.columns, *(f"run_{c}_{n}" for c in ("hash", "plain") for n in lengths)}
    assert "lambda slice" not in runs._jdf.queryExecution().optimizedPlan().toString()
    seen = {}
    for r in runs.collect():
        tokens = words[r["id"]].split()
        for n in lengths:
            said = [" ".join(tokens[i:i + n]) for i in range(max(0, len(tokens) - n + 1))]
            for kind in ("hash", "plain"):
                assert len(r[f"run_{kind}_{n}"]) == len(said)
                for s, h in zip(said, r[f"run_{kind}_{n}"]):
                    assert seen.setdefault((kind, s), h) == h
    assert len(set(seen.values())) == len(seen)                 # different runs, lengths and kinds never meet


def _smallest_reachable(links):
    root = {}

    def of(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if None not in (a, b) and a != b:
            root[max(of(a), of(b))] = min(of(a), of(b))
    return {x: of(x) for x in list(root)}


def test_components_steps_broadcast_nothing_and_end_with_stars(spark, monkeypatch):
    plans, materialize = [], components.materialize

    def noted(df):
        out = materialize(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(components, "materialize", noted)
    rng = np.random.default_rng(3)
    shapes = {"none": [], "loops and nulls": [(4, 4), (None, 2), (3, None)], "stars": [(1, i) for i in range(2, 60)] + [(90, 100), (100, 90), (90, 95)],
              "path": [(i, i + 1) for i in range(40)], "hub on top": [(99, i) for i in range(70)], "random": rng.integers(-40, 40, (50, 2)).tolist()}
    rounds = {}
    for name, links in shapes.items():
        plans.clear()
        got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len(got) == len({r.id for r in got}) and {r.id: r.root for r in got} == _smallest_reachable(links), name
        assert not any("Broadcast" in p for p in plans), name
        rounds[name] = len(plans)
    assert rounds["none"] == rounds["loops and nulls"] == rounds["stars"] == 1      # nothing is left to step over
    assert rounds["hub on top"] == 3


def test_turns_of_near_duplicates_join_without_broadcasts(spark):
    roots = spark.createDataFrame([(i, i) for i in range(1, 9)], "rep long, root long")
    joined = near_dup._joined(roots, spark.createDataFrame([(1, 3), (3, 7), (5, 6)], "a long, b long"))
    assert {r.rep: r.root for r in joined.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 5, 7: 1, 8: 8}
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_plans_of_near_duplicates_stay_small(spark, monkeypatch):
    """The driver keeps a description of the whole plan for each stage that ends: a step is not repeated within a plan."""
    rng, exchanges, saved = np.random.default_rng(5), {}, near_dup.saved

    def noted(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[name] = max(exchanges.get(name, 0), plan.count("Exchange "))
        return saved(df, name)

    monkeypatch.setattr(near_dup, "saved", noted)
    rows = []
    for i in range(60):
        words = [f"b{j}" for j in range(150)]
        for at in rng.choice(150, 1 + i % 5, replace=False):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, num=85)
    exchanges["result"] = out._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert "open" in exchanges and max(exchanges.values()) <= 10, exchanges
