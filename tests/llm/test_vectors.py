import numpy as np
import pytest

from brute import Union
from wavemeter.llm.vectors import Tiles, near_vectors, op2_vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, key string, least int, tile int"


def compare(spark, rows, tiles=Tiles()):
    out = near_vectors(spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA), tiles).collect()
    assert len(out) == len(rows)
    groups, links = Union(), dict.fromkeys((r[0] for r in rows), 0)
    fine = []
    for key, vector, label in rows:
        groups.find(key)
        usable = label is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        if not usable:
            continue
        v = np.array(vector, np.float32).astype(np.float64)
        for other, w, of in fine:
            if of == label and len(w) == len(v):
                a, b = v / np.abs(v).max(), w / np.abs(w).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= tiles.threshold:
                    links[key] += 1
                    links[other] += 1
                    groups.join(key, other)
        fine.append((key, v, label))
    for r in out:
        assert (r["n_links"], r["component_id"]) == (links[r["vec_id"]], groups.find(r["vec_id"])), r


def clouds(seed, n, dim=16, labels=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(8, dim))
    rows = []
    for i in range(n):
        v = centres[rnd.integers(8)] + rnd.normal(size=dim) * rnd.choice([0.05, 0.2, 0.3])
        rows.append((int(i * 7 % 1013), v.astype(np.float32).tolist(), int(rnd.integers(labels))))
    return rows


@pytest.mark.parametrize("tiles", [Tiles(), Tiles(tile=20, block=7), Tiles(tile=15, components=5, leading=3, cuts=6)])
def test_against_all_pairs(spark, tiles):
    compare(spark, clouds(1, 400), tiles)


def test_odd_vectors(spark):
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1),
        (6, [float("inf"), 1.0], 1), (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1), (10, [1.0, 1.0], 1),
        (11, [1.0, 1.0, 0.0], 1), (12, [1.0, 1.0], 2), (13, [-0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [1e-38, 1e-38], 1),
        (16, [3e38, 3e38], 1), (17, [1.0], 1), (18, [5.0], 1), (19, [-5.0], 1),
    ]
    compare(spark, rows)
    compare(spark, [])
    compare(spark, rows[:7])


def test_many_copies_in_one_label(spark):
    rnd = np.random.default_rng(2)
    same = rnd.normal(size=24).astype(np.float32).tolist()
    rows = [(n, same, 1) for n in range(150)] + [(200 + n, rnd.normal(size=24).astype(np.float32).tolist(), 1) for n in range(60)]
    compare(spark, rows, Tiles(tile=16))


def test_repeated_and_null_keys(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in out) == [(0, 2, 0), (1, 2, 1), (1, 2, 1), (2, 0, 2)]


def test_threshold_is_met_from_above(spark):
    angle = np.arccos(0.93)
    rows = [(1, [1.0, 0.0], 1)]
    rows += [(2 + n, [float(np.cos(angle + d)), float(np.sin(angle + d))], 1) for n, d in enumerate((1e-6, -1e-6))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(df).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_driver_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(spark, rows)
    out = op2_vector_dedup(spark, sf).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out) and len(out) == len(rows)
