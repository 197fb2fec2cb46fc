"""Model preparation and comparison on the basetable.

Order of work (fixing the reference's leakage, SURVEY §7.4 item 8): time-ordered
70/30 split of the train basetable first, preprocessing fitted on the 70 % only, then
the same fitted pipeline applied to the 30 % and to the holdout. Prepared frames are
persisted (MEMORY_AND_DISK: a lost executor recomputes its blocks from lineage) since
every model reads them several times.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import importance as IM
from orderlens.operators import metrics as MT
from orderlens.operators import models as M
from orderlens.operators import prep as PR
from orderlens.operators import split as S
from orderlens.operators.boosting import BlockGBTClassifier
from orderlens.plans import basetable as B
from orderlens.plans import features as FE
from orderlens.session import materialize

# The feature columns, by name.
NUMERIC = [
    "delivery_duration_days", "delivery_delay_days", "duration_flag", "delays_flag",
    *[f"{t}_installments" for t in FE.NORMALIZED_PAYMENT_TYPES],
    *[f"{t}_amount" for t in FE.NORMALIZED_PAYMENT_TYPES],
    "in_top_20", "not_in_top_20",
    "avg_price", "avg_ship_cost", "avg_prod_name_length", "avg_prod_desc_length", "avg_photos_qty",
    "avg_prod_weight_g", "avg_prod_volume_cm3",
]
CATEGORICAL = ["status", "repeat_customer", "payment_methods"]
SPLIT_SHARE = 0.7


@dataclass
class Prepared:
    train: DataFrame        # (order_id, features, label) first 70 % in time order
    valid: DataFrame        # the remaining 30 %
    holdout: DataFrame      # (order_id, features)
    n_features: int
    names: list[str]
    sides: tuple[DataFrame, DataFrame, DataFrame]  # the basetable parts behind them
    cache: dict[str, Any] = field(default_factory=dict)

    def release(self) -> None:
        for d in (self.train, self.valid, self.holdout, *[x for x in self.cache.values() if isinstance(x, DataFrame)]):
            d.unpersist()

    @property
    def train_binary(self) -> DataFrame:
        return B.binary_label(self.train)

    @property
    def valid_binary(self) -> DataFrame:
        return B.binary_label(self.valid)

    @property
    def train_multi(self) -> DataFrame:
        return self.train.where("label <> 0")

    @property
    def valid_multi(self) -> DataFrame:
        return self.valid.where("label <> 0")

    @property
    def full_binary(self) -> DataFrame:
        return B.binary_label(self.every_score)

    @property
    def full_multi(self) -> DataFrame:
        return self.every_score.where("label <> 0")

    @property
    def every_score(self) -> DataFrame:
        """All train orders; those without a review have score 0."""
        return self.train.unionByName(self.valid)


_PREPARED: dict[tuple, Prepared] = {}


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    key = B.memo_key(spark, sf_dir)
    if key not in _PREPARED:
        for old in [k for k in _PREPARED if k[:2] == key[:2]]:  # the files changed: their frames are of no more use
            _PREPARED.pop(old).release()
        bt = B.materialized_basetable(spark, sf_dir)
        ho = B.materialized_basetable(spark, sf_dir, holdout=True)
        first, rest = S.split_time_prefix(bt, "order_purchase_timestamp", "order_id", SPLIT_SHARE)
        _, (tr, va, hd) = PR.prepare(first, [rest, ho], "review_score", "order_id", NUMERIC, CATEGORICAL)
        tr, va, hd = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (tr, va, hd))
        _PREPARED[key] = Prepared(tr, va, hd, M.num_features(tr), PR.feature_names(tr), (first, rest, ho))
    return _PREPARED[key]


def binary_board(p: Prepared) -> tuple[DataFrame, dict[str, Any]]:
    if "binary_board" not in p.cache:
        p.cache["binary_board"] = M.leaderboard(p.train_binary, p.valid_binary, M.binary_estimators(p.n_features))
    return p.cache["binary_board"]


def importances(p: Prepared) -> DataFrame:
    """``(feature, importance)`` of the leaderboard's winner, adding up to 1: its own for tree ensembles, by
    permutation on the validation orders for every other model."""
    if "importances" not in p.cache:
        board, fitted = binary_board(p)
        model = fitted[M.model_select(board).first()["model"]]
        spark = p.train.sparkSession
        if hasattr(model, "featureImportances"):
            p.cache["importances"] = M.feature_importance(spark, model, p.names)
        else:
            p.cache["importances"] = materialize(IM.normalised(permuted_importances(p, model)), "importances")
    return p.cache["importances"]


def permuted_importances(p: Prepared, model: Any) -> DataFrame:
    """Permutation importances of a binary model on the validation orders."""
    return IM.model_importance(model, p.valid_binary, p.names, MT.margin)


def final_gbt() -> BlockGBTClassifier:
    return BlockGBTClassifier(seed=M.GBT_SEED_FINAL, maxDepth=M.GBT_FINAL_DEPTH)


def scored_splits(p: Prepared, seed: int) -> DataFrame:
    """A depth-10 GBT fitted on the binary train split, scoring both the train and the
    validation split: ``(split, order_id, label, p_0, p_1, max_score)``, the inputs of
    the reference's train-versus-validate ROC and lift curves."""
    key = f"scored_splits_{seed}"
    if key not in p.cache:
        model = BlockGBTClassifier(seed=seed, maxDepth=M.GBT_FINAL_DEPTH).fit(p.train_binary)
        parts = []
        for name, d in (("train", p.train_binary), ("validate", p.valid_binary)):
            scored = M.probability_columns(model.transform(d)).withColumn("split", F.lit(name))
            parts.append(M.row_max_score(scored.select("split", "order_id", "label", "p_0", "p_1"),
                                         ["p_0", "p_1"], "max_score"))
        # Persisted: the running sums behind ROC and lift read their input three times.
        p.cache[key] = parts[0].unionByName(parts[1]).persist(StorageLevel.MEMORY_AND_DISK)
    return p.cache[key]


def final_binary(p: Prepared, unreviewed: bool = False) -> Any:
    """The final binary model, fitted once on all reviewed train orders; with ``unreviewed`` also on those
    without a review, as negatives."""
    key = "final_binary_unreviewed" if unreviewed else "final_binary"
    if key not in p.cache:
        p.cache[key] = final_gbt().fit(B.binary_label(p.every_score, drop=()) if unreviewed else p.full_binary)
    return p.cache[key]


def validation_ovr(p: Prepared) -> Any:
    """One-vs-rest on the train split, read by predictions, confusion matrix and metrics."""
    if "validation_ovr" not in p.cache:
        p.cache["validation_ovr"] = M.ovr_fit(p.train_multi, final_gbt())
    return p.cache["validation_ovr"]


def final_ovr(p: Prepared, unreviewed: bool = False) -> Any:
    """The final one-vs-rest model on scores 1-5; with ``unreviewed`` on 0-5, where 0 is an order without a review."""
    key = "final_ovr_unreviewed" if unreviewed else "final_ovr"
    if key not in p.cache:
        p.cache[key] = M.ovr_fit(p.every_score if unreviewed else p.full_multi, final_gbt(), 0 if unreviewed else M.FIRST_CLASS)
    return p.cache[key]


def svc_splits(p: Prepared) -> DataFrame:
    """``(split, order_id, label, score)``: the margins of the compared LinearSVC, a model without probabilities."""
    if "svc_splits" not in p.cache:
        model = binary_board(p)[1]["LinearSVC"]
        parts = [MT.margin(model.transform(d)).select(F.lit(name).alias("split"), "order_id", "label", "score")
                 for name, d in (("train", p.train_binary), ("validate", p.valid_binary))]
        p.cache["svc_splits"] = parts[0].unionByName(parts[1]).persist(StorageLevel.MEMORY_AND_DISK)
    return p.cache["svc_splits"]


def class_margins(p: Prepared) -> DataFrame:
    """``(order_id, class, score, label)``: the margins of the five one-vs-rest models on the validation orders."""
    if "class_margins" not in p.cache:
        scored = M.ovr_transform(validation_ovr(p), p.valid_multi)
        out = MT.class_margins(scored, [1.0, 2.0, 3.0, 4.0, 5.0], keep=["order_id"])
        p.cache["class_margins"] = out.persist(StorageLevel.MEMORY_AND_DISK)
    return p.cache["class_margins"]


def final_scores(p: Prepared, unreviewed: bool = False) -> DataFrame:
    """(order_id, prediction_binary, prediction_multiclass) of every holdout order."""
    return M.score_merge(M.predictions(final_binary(p, unreviewed), p.holdout, keep_label=False),
                         M.ovr_scores(final_ovr(p, unreviewed), p.holdout, keep_label=False, first=0 if unreviewed else M.FIRST_CLASS))


def selected_columns(p: Prepared) -> list[str]:
    """Source columns of the most important features (all of them if none stands out)."""
    top = M.feature_select_topk(importances(p)).collect()  # 10 rows at most
    return M.source_columns([r["feature"] for r in top], NUMERIC, CATEGORICAL) or [*NUMERIC, *CATEGORICAL]


def refit(train: DataFrame, valid: DataFrame, others: list[DataFrame], columns: list[str],
          unseen: str = "keep") -> tuple[Any, DataFrame, list[DataFrame]]:
    """Pipeline and final binary GBT fitted on ``columns`` of ``train``: (model, validation
    scored as (order_id, label, p_1), the other frames prepared)."""
    numeric, categorical = [c for c in NUMERIC if c in columns], [c for c in CATEGORICAL if c in columns]
    _, (tr, va, *rest) = PR.prepare(train, [valid, *others], "review_score", "order_id", numeric, categorical, unseen=unseen)
    tr = B.binary_label(tr).persist(StorageLevel.MEMORY_AND_DISK)
    model = final_gbt().fit(tr)
    tr.unpersist()
    scored = M.probability_columns(model.transform(B.binary_label(va))).select("order_id", "label", "p_1")
    return model, scored, rest


def selected_refit(p: Prepared) -> tuple[DataFrame, DataFrame]:
    """Refit on the selected features: (validation scores, holdout predictions)."""
    if "selected_refit" not in p.cache:
        first, rest, holdout = p.sides
        model, scored, (hold,) = refit(first, rest, [holdout], selected_columns(p))
        p.cache["selected_refit"] = scored, M.predictions(model, hold, keep_label=False)
    return p.cache["selected_refit"]


def stratified_parts(p: Prepared, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """The reviewed train orders: a hash sample of ``share`` of every score, and its complement."""
    first, rest, _ = p.sides
    reviewed = first.unionByName(rest).where("review_score <> 0")
    train = S.stratified_sample(reviewed, "order_id", "review_score", {float(s): share for s in range(1, 6)})
    return train, S.complement(reviewed, train, "order_id")


def stratified_refit(p: Prepared) -> tuple[DataFrame, DataFrame]:
    """Binary refit on the selected features and the stratified sample: (complement scored, holdout predictions)."""
    if "stratified_refit" not in p.cache:
        train, valid = stratified_parts(p)
        model, scored, (hold,) = refit(train, valid, [p.sides[2]], selected_columns(p))
        p.cache["stratified_refit"] = scored, M.predictions(model, hold, keep_label=False)
    return p.cache["stratified_refit"]


def multi_refit(p: Prepared) -> tuple[DataFrame, DataFrame]:
    """One-vs-rest refit on the selected features and the stratified sample: the complement as
    (order_id, label, prediction), and the holdout predictions, both as scores 1-5."""
    if "multi_refit" not in p.cache:
        columns = selected_columns(p)
        numeric, categorical = [c for c in NUMERIC if c in columns], [c for c in CATEGORICAL if c in columns]
        train, valid = stratified_parts(p)
        _, (tr, va, hold) = PR.prepare(train, [valid, p.sides[2]], "review_score", "order_id", numeric, categorical, unseen="keep")
        tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
        model = M.ovr_fit(tr, final_gbt())
        tr.unpersist()
        p.cache["multi_refit"] = (materialize(M.ovr_scores(model, va), "multi-refit"), M.ovr_scores(model, hold, keep_label=False))
    return p.cache["multi_refit"]


def refit_scores(p: Prepared) -> DataFrame:
    """(order_id, prediction_binary, prediction_multiclass) of every holdout order, by the refitted models."""
    return M.score_merge(stratified_refit(p)[1], multi_refit(p)[1])
