"""The batch steps chained together: clean, enrich, feature, matrix, train, explain.

The player table is written once per call, because several statistics passes read it. The order
matters: limits first, then RFM, then features, so features and segments see winsorised values.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.operators.clean import Preprocessor, apply_winsor, assemble, fit_winsor, remove_duplicates
from lapsewise.operators.enrich import engineer_features, with_rfm
from lapsewise.operators.explain import contributions, feature_means, risk_table, top_risk
from lapsewise.operators.models import Bundle, Fitted, best_bundle, compare_models, score, train_models
from lapsewise.operators.resample import smote
from lapsewise.operators.split import exact_split, hash_split
from lapsewise.sources.workspace import materialise


def enrich(players: DataFrame, order: str | None = None, fit_on: str = "all") -> DataFrame:
    """Deduplicated (if an order column is named), winsorised players with RFM columns.

    ``fit_on="train"`` takes the winsor limits from the train split only; ``players`` then needs a
    split column.
    """
    rows = remove_duplicates(players, K.ID, order) if order else players
    rows = materialise(rows, "players")
    base = rows.where(F.col("split") == "train") if fit_on == "train" else rows
    return with_rfm(apply_winsor(rows, fit_winsor(base, K.NUMERIC_FEATURES)))


def featured(players: DataFrame, order: str | None = None) -> DataFrame:
    return engineer_features(enrich(players, order))


@dataclass
class Matrices:
    """Scaled features of all splits in one table, and the fitted preprocessor."""

    table: DataFrame
    preprocessor: Preprocessor

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)


def split_matrices(enriched: DataFrame, exact: bool = False, seed: int = 42) -> Matrices:
    """Split, fit the preprocessor on train, scale everything. Engineered features stay out."""
    cut = exact_split if exact else hash_split
    rows = enriched if "split" in enriched.columns else cut(enriched, seed=seed)
    rows = materialise(rows, "split")
    prep = Preprocessor(K.NUMERIC_FEATURES + K.RFM_FEATURES).fit(rows.where(F.col("split") == "train"))
    return Matrices(materialise(prep.transform(rows, [K.ID, "split", K.LABEL]), "matrix"), prep)


def train(matrices: Matrices, balance: bool = True, **options) -> Fitted:
    """Balance the train split, then fit and tune the candidates."""
    rows = matrices.part("train").drop("split")
    if balance:
        rows = smote(rows, matrices.preprocessor.feature_names).drop("synthetic")
    return train_models(rows, matrices.part("val"), matrices.preprocessor, **options)


def train_and_compare(matrices: Matrices, **options) -> tuple[Bundle, DataFrame]:
    """The best candidate as a bundle, and the test-set comparison of all of them."""
    fitted = train(matrices, **options)
    table = materialise(compare_models(fitted, matrices.part("test")), "comparison")
    return best_bundle(fitted, table), table


def explain_risk(bundle: Bundle, matrix: DataFrame, players: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """(attributions of every row, top-risk table).

    The table attributes its n rows only; the full attributions stay lazy until they are read.
    """
    scored = materialise(score(bundle.model, assemble(matrix, bundle.features)).drop("features"), "scored")
    means = feature_means(matrix, bundle.features)
    listed = matrix.join(F.broadcast(top_risk(scored, n).select(K.ID)), K.ID, "left_semi")
    few = contributions(listed, bundle.features, bundle.model, means)
    everything = contributions(matrix, bundle.features, bundle.model, means)
    return everything, risk_table(scored, few, players, bundle.threshold, n)
