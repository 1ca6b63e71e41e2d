"""Fitted tree ensembles as plain expressions.

A look-up that prices a few zones should not start an ML pipeline, and a table of any
size should be scored inside the projection that already reads it.  `from_pipeline`
takes a fitted pipeline (imputer, assembler, scaler, boosted trees) apart into numbers,
`sql_columns` writes them as SQL expressions - one per scaled feature, one per tree, and
their weighted sum - and `with_prediction` adds them to a DataFrame as ordinary columns.
The expressions use CASE, + and * only, so other engines run the same text.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonefare.config import FEATURE_COLUMNS

DEFAULT_ENSEMBLE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "default_ensemble.json")


@dataclass(frozen=True)
class Ensemble:
    """Per feature the value for a missing one, mean and scale; trees as nested [feature, threshold, left, right] or a leaf."""
    features: tuple
    medians: tuple
    means: tuple
    scales: tuple
    weights: tuple
    trees: tuple

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Ensemble:
        return Ensemble(**{k: tuple(v) for k, v in json.loads(text).items()})


def default_ensemble() -> Ensemble:
    """The ensemble that ships with the library (scripts/train_default.py)."""
    with open(DEFAULT_ENSEMBLE, encoding="utf-8") as f:
        return Ensemble.from_json(f.read())


def _node(lines: list[str]) -> list | float:
    """The first node of a tree's text, which is taken off the lines."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    left = _node(lines)
    if not lines.pop(0).strip().startswith("Else"):
        raise ValueError("not a tree over numbers")
    return [int(feature), float(threshold), left, _node(lines)]


def from_pipeline(model: PipelineModel) -> Ensemble:
    imputer, _, scaler, booster = model.stages
    medians = imputer.surrogateDF.first()
    trees = [_node(t.toDebugString.split("\n")[1:]) for t in booster.trees]
    return Ensemble(tuple(FEATURE_COLUMNS), tuple(float(medians[c]) for c in FEATURE_COLUMNS),
                    tuple(float(x) for x in scaler.mean), tuple(1.0 / float(s) if s else 0.0 for s in scaler.std),
                    tuple(float(w) for w in booster.treeWeights), tuple(trees))


def _number(x: float) -> str:
    """A literal that Spark and other engines read as a double."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def _case(node) -> str:
    if not isinstance(node, (list, tuple)):
        return _number(node)
    feature, threshold, left, right = node
    return f"CASE WHEN z{feature} <= {_number(threshold)} THEN {_case(left)} ELSE {_case(right)} END"


def sql_columns(e: Ensemble, booleans: tuple = ()) -> tuple[dict[str, str], dict[str, str], str]:
    """(scaled features z0.., trees t0.. over them, the sum over those) as SQL texts; unused features are left out."""
    def used(node, out: set) -> set:
        if isinstance(node, (list, tuple)):
            out.add(node[0])
            used(node[2], out)
            used(node[3], out)
        return out
    wanted = sorted(set().union(*[used(t, set()) for t in e.trees])) if e.trees else []
    number = lambda c: f"CAST(CAST({c} AS INTEGER) AS DOUBLE)" if c in booleans else f"CAST({c} AS DOUBLE)"
    scaled = {f"z{i}": f"(coalesce({number(e.features[i])}, {_number(e.medians[i])}) - {_number(e.means[i])}) * {_number(e.scales[i])}"
              for i in wanted}
    trees = {f"t{k}": _case(t) for k, t in enumerate(e.trees)}
    total = " + ".join(f"{_number(w)} * t{k}" for k, w in enumerate(e.weights)) or "0e0"
    return scaled, trees, total


def with_prediction(df: DataFrame, e: Ensemble, name: str = "prediction") -> DataFrame:
    """All columns of a feature table and the ensemble's raw prediction."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    booleans = tuple(c for c in e.features if kinds.get(c) == "boolean")
    floating = [c for c in e.features if kinds.get(c) in ("double", "float")]
    scaled, trees, total = sql_columns(e, booleans)
    # NaN counts as missing, as in the imputer
    known = df.withColumns({f"__f_{c}": F.nanvl(F.col(c), F.lit(None).cast(kinds[c])) for c in floating})
    for c in floating:
        scaled = {z: t.replace(f"CAST({c} AS DOUBLE)", f"CAST(__f_{c} AS DOUBLE)") for z, t in scaled.items()}
    out = known.withColumns({z: F.expr(t) for z, t in scaled.items()})
    out = out.withColumns({t: F.expr(x) for t, x in trees.items()})
    return out.withColumn(name, F.expr(total)).drop(*scaled, *trees, *[f"__f_{c}" for c in floating])

