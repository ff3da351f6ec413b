"""No link is lost between cells, however many there are."""

import numpy as np

from tallyhouse.llm import vectors


def test_links_across_hundreds_of_cells(spark):
    """Uniform directions, each with a partner at a cosine just above the limit; against all pairs."""
    draw = np.random.default_rng(12)
    one = vectors.units(draw.standard_normal((1500, 32)))
    side = draw.standard_normal(one.shape)
    side = vectors.units(side - (side * one).sum(axis=1, keepdims=True) * one)
    cosine = draw.uniform(0.9005, 0.93, (len(one), 1))
    rows = np.concatenate((one, cosine * one + np.sqrt(1 - cosine ** 2) * side))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "vec_id long, embedding array<double>")
    unit = vectors.units(rows)
    links = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    assert links.sum() >= 3000
    # A wide bound, so that what is lost could only be lost between cells.
    plan = vectors.Plan(cell_rows=10, sureness=8.0)
    found = {r.vec_id: r.n_links for r in vectors.vector_groups(df, plan).collect()}
    assert found == dict(enumerate(links.tolist()))
