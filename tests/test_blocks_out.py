"""Only what is asked for leaves the blocks of the K-Means steps, and blocks hold rows of one width."""

import numpy as np
import pytest

from larder.operators import clustering as K
from tests.test_density import frame


def test_labels_leave_the_blocks_alone(spark):
    x = np.random.default_rng(3).normal(size=(500, 4))
    rows = K.Rows(frame(spark, x).repartition(3), "features")
    fits = [K.Centres(x[:3], 0.0, 1), K.Centres(x[10:15], 0.0, 1)]
    both, alone = K.nearest_labels(rows, fits), K.nearest_labels(rows, fits, with_features=False)
    assert both.columns == ["row_id", "features", "labels"] and alone.columns == ["row_id", "labels"]
    near = [((x[:, None] - f.centres[None]) ** 2).sum(axis=2).argmin(axis=1) for f in fits]
    ids = [r.row_id for r in frame(spark, x).collect()]
    want = {i: [int(near[0][k]), int(near[1][k])] for k, i in enumerate(ids)}
    assert {r.row_id: r.labels for r in alone.collect()} == want == {r.row_id: r.labels for r in both.collect()}
    assert {r.row_id: r.features for r in both.collect()} == {i: x[k].tolist() for k, i in enumerate(ids)}


@pytest.mark.parametrize("bad", [[1.0], None])
def test_rows_of_other_widths_are_refused(spark, bad):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "row_id long, features array<double>").coalesce(1)
    with pytest.raises(Exception, match="widths"):
        K.Rows(rows, "features")
