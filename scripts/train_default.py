"""Train the small ensemble that the price look-ups ship with, and write it as JSON.

usage: python scripts/train_default.py [sf_dir]
Six trees of depth 3 on the feature table of the given data (labels by formula).
"""

from __future__ import annotations

import os
import sys
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonefare.config import DEFAULT  # noqa: E402
from zonefare.model import compile as C  # noqa: E402
from zonefare.model import training as M  # noqa: E402
from zonefare.plans import serving as S  # noqa: E402
from zonefare.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    h = S.surge_history(spark, sf_dir, "hour")
    frame = M.to_training_frame(S.feature_rows(h, S.historical_baseline(h)), S.label_column())
    cfg = replace(DEFAULT, gbt_max_iter=6, gbt_max_depth=3, gbt_step_size=0.4)
    trained = M.train(frame, cfg)
    print(M.metrics(trained.model, trained.test).first())
    with open(C.DEFAULT_ENSEMBLE, "w", encoding="utf-8") as f:
        f.write(C.from_pipeline(trained.model).to_json() + "\n")


if __name__ == "__main__":
    main()
