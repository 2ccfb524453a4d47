"""Record validation, batch scoring, response columns and what-if scenarios.

Records arrive as JSON text in a column ``record``. They are parsed to a variant, which keeps a
missing field, a JSON null and a wrong type apart, and everything after that is column
expressions over the whole batch.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.labels import board_message, board_tier, gauge_band, recommendation, risk_tier
from lapsewise.functions.numeric import num, round_even
from lapsewise.operators.enrich import serving_rfm
from lapsewise.operators.models import Bundle, score
from lapsewise.operators.clean import assemble


def json_kind(field: Column, schema: Column) -> Column:
    """missing, null, str, bool, int, float, list or dict of a variant field."""
    return (
        F.when(field.isNull(), F.lit("missing"))
        .when(schema == "VOID", F.lit("null"))
        .when(schema == "STRING", F.lit("str"))
        .when(schema == "BOOLEAN", F.lit("bool"))
        .when(schema == "BIGINT", F.lit("int"))
        .when(schema.startswith("ARRAY"), F.lit("list"))
        .when(schema.startswith("OBJECT"), F.lit("dict"))
        .otherwise(F.lit("float"))
    )


def json_number(field: Column, kind: Column) -> Column:
    """A number, or true/false as 1/0, as double; null for anything else."""
    return F.when(kind.isin("int", "float"), F.try_variant_get(field, "$", "double")).when(
        kind == "bool", F.try_variant_get(field, "$", "boolean").cast("double")
    )


def number_text(field: Column, kind: Column, value: Column) -> Column:
    """How the value is quoted in a message: integers plain, other numbers with a decimal point."""
    whole = F.concat(value.cast("decimal(20,0)").cast("string"), F.lit(".0"))
    return (
        F.when(kind == "bool", F.when(value == 1, F.lit("True")).otherwise(F.lit("False")))
        .when(kind == "int", F.try_variant_get(field, "$", "string"))
        .when((value == F.floor(value)) & (F.abs(value) < 1e16), whole)
        .otherwise(F.try_variant_get(field, "$", "string"))
    )


def type_name(kind: Column) -> Column:
    return F.when(kind == "null", F.lit("NoneType")).otherwise(kind)


def field_error(name: str, field: Column, kind: Column, value: Column) -> Column:
    """The message for one field, null if it is fine. Bounds are inclusive."""
    missing = F.when(kind == "missing", F.lit(f"Missing required field: '{name}'"))
    if name == K.MODE:
        wrong = F.concat(F.lit(f"Field '{name}' must be {K.STRING_TYPE_TEXT}, got "), type_name(kind))
        return missing.when(kind != "str", wrong)
    low, high = K.FIELD_BOUNDS[name]
    wrong = F.concat(F.lit(f"Field '{name}' must be {K.NUMBER_TYPES_TEXT}, got "), type_name(kind))
    outside = F.concat(
        F.lit(f"Field '{name}' = "), number_text(field, kind, value), F.lit(f" is out of range [{low}, {high}]")
    )
    return missing.when(value.isNull(), wrong).when(
        (value < F.lit(float(low))) | (value > F.lit(float(high))), outside
    )


def mode_error(kind: Column, value: Column) -> Column:
    """Separate check of the mode's value, so a non-string mode gives two messages."""
    known = F.coalesce(value.isin(K.GAME_MODES), F.lit(False))
    return F.when((kind != "missing") & ~known, F.lit(f"{K.MODE} must be one of {K.MODES_TEXT}"))


def validate(records: DataFrame, record: str = "record") -> DataFrame:
    """Add the typed request fields and ``errors`` (array<string>, empty when valid).

    Text that is not a JSON object has the single error 'Request body must be valid JSON.'. The
    steps are separate projections, so each record is parsed and each field looked up once.
    """
    names = K.REQUEST_FIELDS
    is_object = F.ltrim(F.col(record)).startswith("{")
    parsed = records.withColumn("_v", F.when(is_object, F.try_parse_json(F.col(record))))
    fields = parsed.withColumns({f"_f_{n}": F.try_variant_get(F.col("_v"), f"$.{n}", "variant") for n in names})
    schemas = fields.withColumns({f"_s_{n}": F.schema_of_variant(f"_f_{n}") for n in names})
    kinds = schemas.withColumns({f"_k_{n}": json_kind(F.col(f"_f_{n}"), F.col(f"_s_{n}")) for n in names})
    typed = kinds.withColumns({
        n: F.when(F.col(f"_k_{n}") == "str", F.try_variant_get(F.col(f"_f_{n}"), "$", "string"))
        if n == K.MODE
        else json_number(F.col(f"_f_{n}"), F.col(f"_k_{n}"))
        for n in names
    })
    messages = [field_error(n, F.col(f"_f_{n}"), F.col(f"_k_{n}"), F.col(n)) for n in names]
    messages.append(mode_error(F.col(f"_k_{K.MODE}"), F.col(K.MODE)))
    unreadable = F.array(F.lit("Request body must be valid JSON."))
    return typed.select(
        *records.columns,
        *names,
        F.when(F.col("_v").isNull(), unreadable).otherwise(F.array_compact(F.array(*messages))).alias("errors"),
    )


def is_valid(errors: str = "errors") -> Column:
    return F.size(errors) == 0


def response_columns(prob: Column, threshold: float) -> dict[str, Column]:
    return {
        "churn_probability": round_even(prob, 4),
        "churn_probability_pct": round_even(prob * 100.0, 1),
        "predicted_churn": prob >= F.lit(threshold),
        "risk_tier": risk_tier(prob),
        "decision_threshold": F.when(prob.isNotNull(), round_even(F.lit(threshold), 4)),
        "recommendation": recommendation(prob),
    }


def with_response(df: DataFrame, prob: str, threshold: float) -> DataFrame:
    """Add the response columns and the nested input summary."""
    summary = F.struct(*[F.col(c) for c in K.SUMMARY_FIELDS]).alias("input_summary")
    cells = [c.alias(name) for name, c in response_columns(F.col(prob), threshold).items()]
    return df.select("*", *cells, summary)


def with_board(df: DataFrame, prob: str) -> DataFrame:
    """Three-level tier, its message and the gauge band."""
    p = F.col(prob)
    return df.select("*", board_tier(p).alias("tier"), board_message(p).alias("message"), gauge_band(p).alias("gauge"))


def score_players(df: DataFrame, bundle: Bundle, cap_days: bool = True) -> DataFrame:
    """Probability for raw player rows as the service computes it: no winsorising, serving RFM."""
    held = df.withColumn("_row", F.struct(*df.columns))
    matrix = bundle.preprocessor.transform(serving_rfm(held, cap_days), ["_row"])
    return score(bundle.model, assemble(matrix, bundle.features)).select("_row.*", "churn_prob")


def score_records(records: DataFrame, bundle: Bundle, record: str = "record") -> DataFrame:
    """One response per record: prediction columns for valid ones, ``error`` for the others.

    Everything is one narrow plan without a shuffle. Invalid records are scored on null inputs
    (imputed) and their prediction is blanked, which spares a second pass over the input.
    """
    checked = validate(records, record)
    scored = with_response(score_players(checked, bundle), "churn_prob", bundle.threshold)
    valid = is_valid()
    names = [*response_columns(F.lit(0.0), 0.0), "input_summary"]
    return scored.select(
        *records.columns,
        *[F.when(valid, F.col(n)).alias(n) for n in names],
        F.when(~valid, F.col("errors")).alias("error"),
    )


def what_if(df: DataFrame, scenarios: list[dict], bundle: Bundle, key: str = K.ID) -> DataFrame:
    """Score every player under every scenario.

    A scenario is {"scenario": name, field: new value, ...}; fields it does not name keep the
    player's own value. The scenario list is a literal array, so rows are expanded in place.
    """
    spec = F.array(*[
        F.struct(
            F.lit(s["scenario"]).alias("scenario"),
            *[F.lit(None if s.get(c) is None else float(s[c])).cast("double").alias(c) for c in K.NUMERIC_FEATURES],
            F.lit(s.get(K.MODE)).cast("string").alias(K.MODE),
        )
        for s in scenarios
    ])
    altered = df.withColumn("_s", F.explode(spec)).select(
        key, F.col("_s.scenario").alias("scenario"),
        *[F.coalesce(F.col(f"_s.{c}"), num(c)).alias(c) for c in K.NUMERIC_FEATURES],
        F.coalesce(F.col(f"_s.{K.MODE}"), F.col(K.MODE)).alias(K.MODE),
    )
    return with_board(score_players(altered, bundle, cap_days=False), "churn_prob")


def simulator_rows(grid: DataFrame) -> DataFrame:
    """Complete a grid of six sliders to full players: derived playtime and achievements.

    Expects session_count, last_login_days_ago, total_spend_usd, consecutive_losses, win_rate,
    friend_count. Fixed values: 45 minutes, PvP, 0.6 achievements per session.
    """
    sessions = num("session_count")
    return grid.select(
        "*",
        F.lit(45.0).alias("avg_session_duration"),
        (sessions * 45.0 / 60.0).alias("total_playtime_hours"),
        F.lit("PvP").alias(K.MODE),
        (sessions * 0.6).cast("bigint").alias("achievement_count"),
    )
