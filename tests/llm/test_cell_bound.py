"""Shingles counted by cells leave out pairs of strays before their full sets meet."""

from pagetide.llm.minhash import further_pairs


def test_pairs_that_no_cells_allow_are_left_out(spark):
    # Node 2 has the shingles of node 1 in most cells and may be linked; node 3 has half of its shingles in other cells.
    cells = {1: [50, 50, 0], 2: [45, 50, 5], 3: [0, 50, 50]}
    rows = [(9, node, 100, 100, 95, node, [7], cells[node], node - 1) for node in cells]
    schema = "centre long, node long, n long, common long, of_centre long, label long, bands array<long>, cells array<int>, place long"
    pairs = further_pairs(spark.createDataFrame(rows, schema), len(rows), 16, 80).collect()
    assert [(row["a"], row["b"]) for row in pairs] == [(1, 2)]
