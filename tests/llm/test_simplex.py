import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelweave.llm import queries, simplex
from tests.compare import connect, difference
from tests.llm.cases import rows_of

SCHEMA = "vec_id long, embedding array<float>, id string, cluster string, components string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], SCHEMA)


def plain(rows, size, k, rounds):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return sorted(
        (str(i), j, d, sum(x for _, x, y in found if y == j), total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for i, d, j in found
    )


def agree(spark, rows, size=4, k=5, rounds=3):
    got = rows_of(simplex.cluster(table(spark, rows), k, rounds, size))
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted((str(r["vec_id"]), *[r[c] for c in names]) for r in got) == plain(rows, size, k, rounds)
    return got


def random_rows(n, size=4, seed=0, spread=1.0):
    r = np.random.default_rng(seed)
    return [(i, [float(x) for x in r.normal(0, spread, size).astype(np.float32)]) for i in range(n)]


def test_odd_rows(spark):
    rows = random_rows(60)
    rows += [(1, rows[5][1]), (1, rows[5][1]), (None, [0.5] * 4), (None, [-0.5] * 4), (7, None), (8, []), (9, [1.0] * 3), (10, [1.0] * 5)]
    rows += [(11, [1.0, None, 1.0, 1.0]), (12, [float("nan"), 0.0, 0.0, 0.0]), (13, [float("inf"), 0.0, 0.0, 0.0]), (14, [-0.0, -1e-9, 1e-9, 0.0])]
    agree(spark, rows)


@pytest.mark.parametrize("spread", [0.01, 1.0, 1e4])
def test_against_brute_force(spark, spread):
    agree(spark, random_rows(300, size=16, seed=3, spread=spread), size=16, k=7)


def test_ties_go_to_the_smaller_number(spark):
    agree(spark, [(i, [float(i % 3), 0.0, 0.0, 0.0]) for i in range(40)])


def test_one_vector_many_times(spark):
    rows = random_rows(100) + [(1000 + i, [0.25, -0.25, 0.0, 1.0]) for i in range(200)]
    agree(spark, rows)
    agree(spark, [(i, [0.25] * 4) for i in range(50)])


def test_fewer_vectors_than_centroids_and_none(spark):
    agree(spark, random_rows(3))
    assert simplex.cluster(table(spark, random_rows(3)).limit(0)).count() == 0
    assert simplex.cluster(table(spark, [(1, None)])).count() == 0


def test_a_component_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="component out of range"):
        simplex.cluster(table(spark, [(1, [1e30, 0.0, 0.0, 0.0])]), size=4).collect()


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 3, 100, 2**20, 2**26]), st.sampled_from([1, 3, 2**10, 2**26]), st.integers(1, 9))
def test_bounds_hold(seed, near, far, pivots):
    """Also where the sample lies close together and the vectors far from it."""
    r = np.random.default_rng(seed)
    sample = r.integers(-near, near + 1, (20, 8))
    vectors, others = r.integers(-far, far + 1, (30, 8)), r.integers(-near, near + 1, (6, 8))
    base = simplex.choose_pivots(sample, pivots)
    lower, upper = simplex.bounds(base.apexes(vectors), base.apexes(others))
    exact = np.sqrt(np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, o)) for o in others] for v in vectors], float))
    assert (lower <= exact * (1 + 1e-12)).all() and (upper >= exact * (1 - 1e-12)).all()


def test_bounds_leave_few_to_compare(spark):
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (5, 16))
    rows = [(i, [float(x) for x in (centres[i % 5] + r.normal(0, 0.02, 16)).astype(np.float32)]) for i in range(400)]
    got = rows_of(simplex.cluster(table(spark, rows), 5, 3, 16))
    assert sum(r["n_compared"] for r in got) < 2 * len(got)


def test_query(spark, sf_dir="/root/testdata/sf0.001"):
    assert difference(queries.op12_simplex(spark, sf_dir), connect(sf_dir), queries.ORACLE["op12_simplex"]) is None
