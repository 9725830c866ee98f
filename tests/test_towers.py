import json
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil import storage
from vigil.config import TrainConfig
from vigil.operators import towers as tw

CFG = TrainConfig(max_rounds=4, patience=4, seed=7, workers=3, batch_rows=16)
WIDTHS = {"frames": 4, "series": 6, "text": 3, "tokens": 32}


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(1)
    out = []
    for i in range(200):
        y = int(r.random() < 0.3)
        out.append((i, y, (r.normal(y, 1, 4)).tolist(), r.normal(-y, 2, 6).tolist(), r.normal(0, 1, 3).tolist(), [int(x) for x in r.integers(16 * y, 32, r.integers(0, 9))]))
    df = spark.createDataFrame(out, "id long, label int, frames array<double>, series array<double>, text array<double>, tokens array<int>")
    from vigil.session import materialize

    return materialize(tw.weighted(df), "rows")


@pytest.mark.parametrize("preset", sorted(tw.PRESETS))
def test_gradient_is_the_slope_of_the_loss(rows, preset):
    spec = tw.describe(rows, preset, WIDTHS, 2)
    net = tw.Net(spec)
    part = pa.Table.from_batches(rows.limit(20).toArrow().to_batches())
    x, y, w = net.inputs(part), part.column("label").to_numpy().astype(int), part.column("weight").to_numpy()
    flat = net.start(3) + 0.01
    grad, _ = net.gradient(flat, x, y, w, np.random.default_rng(5))
    for at in np.random.default_rng(0).integers(0, net.size, 25):
        step = np.zeros(net.size)
        step[at] = 1e-5
        up, down = (net.gradient(flat + s, x, y, w, np.random.default_rng(5))[1] for s in (step, -step))
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-4 * max(1, abs(grad[at]))


def one_process(rows, spec, cfg, epochs):
    """The same training without tasks, files or barriers."""
    net = tw.Net(spec)
    state, losses = tw.State(net.start(cfg.seed), np.zeros(net.size), np.zeros(net.size)), []
    for epoch in range(epochs):
        dealt = tw.shuffled(rows.select("id", "label", "weight", *spec.widths), "id", cfg.workers, cfg.seed, epoch).withColumn("p", F.spark_partition_id()).toArrow()
        parts = [tw.mini_batches(iter(dealt.filter(pa.compute.equal(dealt.column("p"), p)).to_batches()), cfg.batch_rows) for p in range(cfg.workers)]
        seen, lost = 0, 0.0
        while True:
            got = [tw.part_gradient(net, state.flat, next(p, None), (cfg.seed, epoch, state.step, r)) for r, p in enumerate(parts)]
            n = sum(g[1] for g in got)
            if not n:
                break
            state.adamw(sum(g[0] for g in got) / n, cfg)
            seen, lost = seen + n, lost + sum(g[2] for g in got)
        losses.append(lost / seen)
    return state, losses


def test_equals_one_process_and_goes_on_after_an_end(spark, rows, scratch):
    spec = tw.describe(rows, "tiny", WIDTHS, 2)
    train, val = rows.where("id % 5 <> 0"), rows.where("id % 5 = 0")
    whole = tw.fit(train, val, "id", spec, CFG, scratch("fit").replace("file:", ""))
    state, losses = one_process(train, spec, CFG, 4)
    got = tw.State.of(tw._get(whole.history[-1]["uri"]))
    assert got.step == state.step and np.abs(got.flat - state.flat).max() < 1e-6
    assert np.allclose([h["train_loss"] for h in whole.history], losses, atol=1e-9) and losses[-1] < 0.8 * losses[0]

    folder = scratch("fit").replace("file:", "")
    tw.fit(train, val, "id", spec, replace(CFG, max_rounds=2), folder)  # ended after two epochs
    again = tw.fit(train, val, "id", spec, CFG, folder)
    plain = lambda f: [{k: round(v, 9) if isinstance(v, float) else v for k, v in h.items() if k != "uri"} for h in f.history]
    assert plain(again) == plain(whole)
    found = tw.load(spark, folder)
    assert found.uri == again.uri and found.spec == again.spec
    scored = tw.score(rows, found, ["normal", "offensive"], ("id",))
    assert scored.count() == 200 and scored.columns == ["id", "prediction", "predicted_label", "sensitive", "confidence"]
    best = max(h["val_macro_f1"] for h in found.history)
    assert tw.evaluate(val, found.spec, found.uri)["val_macro_f1"] == pytest.approx(best)
    with pytest.raises(FileNotFoundError):
        tw.load(spark, folder + "-none")


def test_patience_ends_it_and_the_best_state_is_kept(spark, rows, scratch, monkeypatch):
    said = iter([0.5, 0.6, 0.6, 0.4, 0.9])
    monkeypatch.setattr(tw, "evaluate", lambda *a: {"val_log_loss": 1.0, "val_accuracy": 0.0, "val_macro_f1": next(said)})
    folder = scratch("fit").replace("file:", "")
    got = tw.fit(rows, rows, "id", tw.describe(rows, "simple", WIDTHS, 2), replace(CFG, max_rounds=9, patience=2, workers=2), folder)
    assert [h["improved"] for h in got.history] == [True, True, False, False] and got.uri == got.history[1]["uri"]
    assert json.loads(storage.read_text(spark, f"{folder}/history/000003.json"))["epoch"] == 3
    sums = [n for n in storage.names(spark, folder) if n.startswith("sums-0-")]
    assert len(sums) == 1
    left = [len(storage.names(spark, f"{folder}/{sums[0]}/{n}")) for n in storage.names(spark, f"{folder}/{sums[0]}")]
    assert len(left) > 3 and sum(left) <= 2 * 2 + 2  # of the last steps only


def test_a_lost_task_restarts_the_epoch(spark, rows, scratch, monkeypatch):
    folder = scratch("fit").replace("file:", "")
    plain, mark = tw.part_gradient, f"{folder}-lost"

    def flaky(net, flat, part, seed):
        import os

        if seed[1] == 1 and seed[3] == 1 and seed[2] % 3 == 2 and not os.path.exists(mark):
            os.makedirs(mark)
            raise OSError("task lost")
        return plain(net, flat, part, seed)

    spec, cfg = tw.describe(rows, "simple", WIDTHS, 2), replace(CFG, max_rounds=3)
    want = tw.fit(rows, rows, "id", spec, cfg, scratch("fit").replace("file:", ""))
    monkeypatch.setattr(tw, "part_gradient", flaky)
    got = tw.fit(rows, rows, "id", spec, cfg, folder)
    assert storage.names(spark, f"{folder}/history") and [h["train_loss"] for h in got.history] == [h["train_loss"] for h in want.history]
    assert len([n for n in storage.names(spark, folder) if n.startswith("sums-1-")]) == 2


def test_a_worker_without_rows(spark, rows, scratch):
    few = rows.where("id < 2")
    got = tw.fit(few, rows, "id", tw.describe(rows, "simple", WIDTHS, 2), replace(CFG, max_rounds=1), scratch("fit").replace("file:", ""))
    assert got.history[0]["epoch"] == 0 and np.isfinite(got.history[0]["train_loss"])


def test_each_task_steps_its_own_slice_only(tmp_path):
    """Three tasks as threads: each sums and steps a third of the weights, and all end with the weights of the whole step."""
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    size, world, cfg = 1000, 3, TrainConfig()
    r = np.random.default_rng(0)
    start, grads = r.normal(size=size), [r.normal(size=size) for _ in range(world)]

    def task(rank):
        ctx = SimpleNamespace(partitionId=lambda: rank, getTaskInfos=lambda: [None] * world, allGather=lambda _: ["attempt"] * world)
        add = tw.FileSum(ctx, f"{tmp_path}/sums", size)
        state = tw.State(start.copy(), np.zeros(size), np.zeros(size))
        own = state.slice(*add.own)
        for step in range(3):
            empty = step == 1 and rank == 2  # a task whose rows have run out
            share, rows, loss = add(*tw.part_gradient(SimpleNamespace(size=size), state.flat, None, ()) if empty else (grads[rank] * (step + 1), 4, 1.0))
            assert len(share) == add.own[1] - add.own[0] < size / 2 and (rows, loss) == ((8, 2.0) if step == 1 else (12, 3.0))
            own.adamw(share / rows, cfg)
            add.spread(state.flat)
        add.to_first([state.first, state.second])
        return state
    with ThreadPoolExecutor(world) as pool:
        got = list(pool.map(task, range(world)))

    flat, first, second = start, np.zeros(size), np.zeros(size)
    for step in range(3):
        given = grads[:2] if step == 1 else grads
        grad = sum(g * (step + 1) for g in given) / (4 * len(given))
        first, second = 0.9 * first + (1 - 0.9) * grad, 0.999 * second + (1 - 0.999) * grad * grad
        rate = first / (1 - 0.9 ** (step + 1)) / (np.sqrt(second / (1 - 0.999 ** (step + 1))) + 1e-8)
        flat = flat - cfg.learning_rate * (rate + cfg.weight_decay * flat)
    assert all(np.allclose(s.flat, flat, rtol=0, atol=1e-12) for s in got)
    assert np.allclose(got[0].first, first, atol=1e-12) and np.allclose(got[0].second, second, atol=1e-12)


def test_a_part_is_written_without_its_writers_own_slice(tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    size, grads = 10, np.random.default_rng(0).normal(size=(3, 10))

    def task(rank):
        ctx = SimpleNamespace(partitionId=lambda: rank, getTaskInfos=lambda: [None] * 3, allGather=lambda _: ["attempt"] * 3)
        add = tw.FileSum(ctx, f"{tmp_path}/sums", size)
        share, _, _ = add(grads[rank], 4, 1.0)
        return add.own, share
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(task, range(3)))
    for rank, ((a, b), share) in enumerate(got):
        assert np.allclose(share, grads[:, a:b].sum(axis=0)) and (tmp_path / f"sums-attempt/0/part-{rank}").stat().st_size == 16 + 8 * (size - (b - a))
    alone = tw.FileSum(SimpleNamespace(partitionId=lambda: 0, getTaskInfos=lambda: [None], allGather=lambda _: ["one"]), f"{tmp_path}/sums", size)
    assert (alone(grads[0], 4, 1.0)[0] == grads[0]).all()


def test_presets_are_fitted_together_on_rows_described_once(spark, scratch, monkeypatch):
    from threading import Barrier

    from vigil.plans import models

    blocks = [F.array_repeat(F.col("doc_id").cast("double"), w).alias(b) for b, w in models.WIDTHS.items() if b != "tokens"]
    label, split = F.expr("if(doc_id % 5 = 0, null, int(doc_id % 2))"), F.expr("element_at(array('train', 'val', 'test'), int(doc_id % 3) + 1)")
    features = spark.range(60).withColumnRenamed("id", "doc_id").select("doc_id", split.alias("split"), label.alias("label"), *blocks, F.array(F.lit(3)).alias("tokens"))
    meet, described, describe = Barrier(3), [], tw.describe

    def fit(train, val, key, spec, cfg, path):
        meet.wait(60)  # breaks unless all three are fitted at the same time
        return spec.preset, path, train.select("weight").distinct().count(), sorted(r.doc_id for r in val.collect()), spec.idf == described[0].idf
    monkeypatch.setattr(tw, "fit", fit)
    monkeypatch.setattr(tw, "describe", lambda *a: described.append(describe(*a)) or described[-1])
    paths = {p: scratch(p) for p in ("fusion", "tiny", "simple")}
    want = [i for i in range(60) if i % 3 == 1 and i % 5]
    assert models.fit_presets(features, paths) == {p: (p, paths[p], 1, want, True) for p in paths}
    assert len(described) == 1
