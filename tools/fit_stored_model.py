"""Fit the small ensemble that the registered scoring queries apply: ``fit_stored_model.py [sf_dir]``."""

from __future__ import annotations

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rainloom.catalog.derived import KEYS, observations  # noqa: E402
from rainloom.catalog.stored import FEATURES, PATH  # noqa: E402
from rainloom.operators.boosting import fit_ensemble  # noqa: E402
from rainloom.operators.splits import temporal_split  # noqa: E402
from rainloom.plans.features import prepare_features  # noqa: E402
from rainloom.schema import TARGET  # noqa: E402
from rainloom.session import build_session, scratch_scope  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("fit", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    data = temporal_split(prepare_features(observations(spark, sf_dir), keep=["Date"]), tie_cols=KEYS)
    vector = F.array(*[F.col(c).cast("double") for c in FEATURES])
    with scratch_scope(spark, everything=True):
        model = fit_ensemble(data.where("split = 'train'"), vector, FEATURES, F.col(TARGET), n_estimators=12, num_leaves=8)
    for tree in model.trees:          # between two values of the fit, so that the last bit of a value decides nothing
        tree.threshold = [float(f"{t + abs(t) * 1e-7 + 1e-9:.12g}") for t in tree.threshold]
    with open(PATH, "w") as file:
        file.write(model.to_json())


if __name__ == "__main__":
    main()
