"""Column roles of the pupil fact and the preprocessing of model features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from edugauge.operators.aggregates import _long, quantiles_of_counts
from edugauge.session import cut_lineage

# Role -> columns of the pupil fact. Every column has exactly one role.
COLUMN_ROLES: dict[str, list[str]] = {
    "direct_leakage": [
        "VL_PROFICIENCIA_LP", "IN_ALFABETIZADO", "DS_ALFABETIZADO", "IN_PRESENCA_LP", "IN_PREENCHIMENTO_LP",
        "VL_PESO_ALUNO_LP", "FAIXA_PROFICIENCIA", "IN_PARTICIPOU_AVALIACAO", "DS_PARTICIPACAO",
        "DS_SITUACAO_AVALIACAO", "IN_PROVA_VALIDA", "IN_POSSUI_PROFICIENCIA", "DIF_MEDIA_MUNICIPIO",
        "DIF_MEDIA_ESTADO", "IN_ACIMA_MEDIA_MUNICIPIO", "IN_ACIMA_MEDIA_ESTADO", "DESEMPENHO_RELATIVO",
    ],
    "partial_leakage": [
        "PC_ALUNO_ALFABETIZADO", "PC_ALUNO_ALFABETIZADO_ESTADO", "VL_MEDIA_LP", "VL_MEDIA_LP_ESTADO",
        "FAIXA_ALFABETIZACAO", "FAIXA_MEDIA_LP", "DIF_ALFABETIZACAO_MUNICIPIO",
    ],
    "identifiers": [
        "SK_ALUNO", "ID_ALUNO", "ID_ESCOLA", "DT_PROCESSAMENTO", "TS_PROCESSAMENTO", "ANO_CARGA", "MES_CARGA",
        "TP_SERIE", "DS_SERIE", "ANO_REFERENCIA",
    ],
    "redundant": ["CO_UF", "NO_MUNICIPIO", "NO_MUNICIPIO_UF", "CO_MUNICIPIO_IBGE", "DS_DEPENDENCIA"],
    "join_key": ["CO_MUNICIPIO"],
    "socioeconomic": ["PC_FAMILIAS_POBREZA", "RENDA_PER_CAPITA_MEDIA", "MEDIA_INSE"],
    "infrastructure": ["PC_ESCOLAS_BIBLIOTECA", "PC_ESCOLAS_LAB_INFORMATICA", "PC_ESCOLAS_INTERNET_ALUNOS"],
    "safe": ["REGIAO", "SG_UF", "TP_DEPENDENCIA"],
    "target": ["TARGET"],
}
WEIGHT_COLUMN = "VL_PESO_ALUNO_LP"

# Features of the municipality goal model and of the municipality profile.
GOAL_NUMERIC = [
    "PC_ALUNO_ALFABETIZADO_ANTERIOR", "DIF_META_ALFABETIZACAO_ANTERIOR", "PC_FAMILIAS_POBREZA",
    "RENDA_PER_CAPITA_MEDIA", "MEDIA_INSE", "PC_ESCOLAS_BIBLIOTECA", "PC_ESCOLAS_LAB_INFORMATICA",
    "PC_ESCOLAS_INTERNET_ALUNOS",
]
GOAL_CATEGORICAL = ["REGIAO", "SG_UF", "IN_META_ATINGIDA_ANTERIOR"]
GOAL_TARGET = "IN_META_ATINGIDA"
PROFILE_FEATURES = [
    "PC_ALUNO_ALFABETIZADO", "DISTANCIA_META_2030", "PC_FAMILIAS_POBREZA", "RENDA_PER_CAPITA_MEDIA", "MEDIA_INSE",
    "PC_ESCOLAS_BIBLIOTECA", "PC_ESCOLAS_LAB_INFORMATICA", "PC_ESCOLAS_INTERNET_ALUNOS",
]


def feature_groups(socioeconomic: bool = True, infrastructure: bool = False) -> tuple[list[str], list[str]]:
    """(numeric, categorical) features of the pupil model for a scenario."""
    numeric = []
    if socioeconomic:
        numeric += COLUMN_ROLES["socioeconomic"]
    if infrastructure:
        numeric += COLUMN_ROLES["infrastructure"]
    return numeric, list(COLUMN_ROLES["safe"])


def feature_columns(socioeconomic: bool = True, infrastructure: bool = False) -> list[str]:
    """All features of a scenario, the always-safe ones first."""
    numeric, categorical = feature_groups(socioeconomic, infrastructure)
    return categorical + numeric


def check_roles(df: DataFrame) -> None:
    """Raise unless every column of the table has exactly one role and every role column exists."""
    listed = [c for columns in COLUMN_ROLES.values() for c in columns]
    repeated = sorted({c for c in listed if listed.count(c) > 1})
    missing = sorted(set(listed) - set(df.columns))
    unknown = sorted(set(df.columns) - set(listed))
    if repeated or missing or unknown:
        raise ValueError(f"column roles: repeated {repeated}, missing {missing}, without a role {unknown}")


def model_weight(weight: str = WEIGHT_COLUMN) -> Column:
    """Survey weight; pupils without one (not assessed) get the neutral weight 1."""
    return F.coalesce(F.col(weight).cast("double"), F.lit(1.0))


def model_frame(fact: DataFrame, features: Sequence[str], keys: Sequence[str], target: str = "TARGET") -> DataFrame:
    """Key, features, ``label`` and ``weight``: the only columns a fit has to read."""
    weight = model_weight() if WEIGHT_COLUMN in fact.columns else F.lit(1.0)
    return fact.select(
        *keys, *[c for c in features if c not in keys], F.col(target).cast("int").alias("label"), weight.alias("weight")
    )


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent text per column, ``(column_name, value)``; among equals the smallest."""
    counts = (
        _long(df.select(*[F.col(c).cast("string") for c in cols]), cols, "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column_name").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("_best"))
    return best.select("column_name", "_best.value")


def fit_statistics(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """What preprocessing has to know of a training frame, one row per column.

    ``column_name, fill, mean, deviation`` of numbers (the median, and the population moments after filling) and ``mode,
    categories`` of categories (the most frequent text, and all texts after filling, in ascending order). A column without
    any value is filled with 0 or the empty text.

    The frame is read once: equal rows are merged to profiles, profiles to counts by column and value, and every figure comes
    from those counts. Scenarios take the columns they need from one table.
    """
    numeric, categorical = list(numeric), list(categorical)
    profiles = train.groupBy(*dict.fromkeys(numeric + categorical)).agg(F.count(F.lit(1)).alias("_n"))
    nothing = {"number": F.lit(None).cast("double"), "text": F.lit(None).cast("string")}
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("is_number"), F.col(c).cast("double").alias("number"), nothing["text"].alias("text")) for c in numeric]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("is_number"), nothing["number"].alias("number"), F.col(c).cast("string").alias("text")) for c in categorical]
    counts = cut_lineage(
        profiles.select(F.inline(F.array(*entries)), "_n").groupBy("column_name", "is_number", "number", "text").agg(F.sum("_n").alias("_n"))
    )
    given = counts.filter("is_number and number is not null").select("column_name", F.col("number").alias("value"), "_n")
    medians_ = quantiles_of_counts(given, [0.5]).select(F.col("column_name").alias("_name"), F.col("value").alias("_median"))
    # One row per column: bounded by the features of a model.
    numbers = counts.filter("is_number").join(F.broadcast(medians_), F.col("column_name") == F.col("_name"), "left")
    fill = F.coalesce("_median", F.lit(0.0))
    away = F.coalesce(F.col("number") - fill, F.lit(0.0))  # a filled value lies on the fill
    rows = F.sum("_n")
    shift = F.sum(away * F.col("_n")) / rows
    spread = F.sqrt(F.greatest(F.lit(0.0), F.sum(away * away * F.col("_n")) / rows - shift * shift))
    moments = numbers.groupBy("column_name").agg(F.max(fill).alias("fill"), (F.max(fill) + shift).alias("mean"), spread.alias("deviation"))
    known = F.col("text").isNotNull()
    listed = counts.filter("not is_number").groupBy("column_name").agg(
        F.coalesce(F.min(F.when(known, F.struct(-F.col("_n"), F.col("text"))))["text"], F.lit("")).alias("mode"),
        F.collect_set("text").alias("_texts"),  # the categories, which a model holds on the driver
    )
    texts = F.when(F.size("_texts") > 0, F.array_sort("_texts")).otherwise(F.array(F.lit("")))
    listed = listed.select("column_name", "mode", texts.alias("categories"))
    return moments.unionByName(listed, allowMissingColumns=True)


@dataclass
class Statistics:
    """The rows of :func:`fit_statistics` by column: parameters of a model, on the driver."""

    rows: dict[str, Row]

    @classmethod
    def of(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Statistics:
        return cls({row["column_name"]: row for row in fit_statistics(train, numeric, categorical).collect()})

    def number(self, column: str) -> tuple[float, float, float]:
        """Fill, mean and deviation; of a frame without rows 0, 0 and 1."""
        row = self.rows.get(column)
        return (row["fill"], row["mean"] or 0.0, row["deviation"] or 1.0) if row else (0.0, 0.0, 1.0)

    def texts(self, column: str) -> tuple[str, list[str]]:
        """Fill and categories; of a frame without rows one empty category."""
        row = self.rows.get(column)
        return (row["mode"], list(row["categories"])) if row else ("", [""])


@dataclass
class Preprocessor:
    """Fitted preprocessing: raw features in, a ``features`` vector out."""

    stages: PipelineModel
    numeric: list[str]
    categorical: list[str]
    categories: dict[str, list[str]]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stages.transform(df)

    @property
    def feature_names(self) -> list[str]:
        """Expanded names in vector order: numbers, then ``column=value`` per category."""
        return self.numeric + [f"{c}={v}" for c in self.categorical for v in self.categories[c]]

    @property
    def variables(self) -> list[tuple[str, int]]:
        """Original variables in vector order, each with the number of its slots."""
        return [(c, 1) for c in self.numeric] + [(c, len(self.categories[c])) for c in self.categorical]


#: Category of the empty text: a label must not be empty.
EMPTY = " "


def _number(value: float) -> str:
    return f"cast('{value!r}' AS DOUBLE)"


def fit_preprocessor(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], statistics: Statistics | None = None
) -> Preprocessor:
    """Median fill and standardisation for numbers, mode fill and one-hot for categories.

    All figures come from ``train`` only, or from the ``statistics`` already taken of it. Only model parameters reach the
    driver: one median, mean and deviation per number, one mode and the category list per category. A category unseen in
    ``train`` becomes an all-zero block.
    """
    numeric, categorical = list(numeric), list(categorical)
    found = statistics or Statistics.of(train, numeric, categorical)
    exprs = ["*"]
    for c in numeric:
        fill, mean, deviation = found.number(c)
        value = f"coalesce(cast(`{c}` AS DOUBLE), {_number(fill)})"
        exprs.append(f"({value} - {_number(mean)}) / {_number(deviation)} AS `{c}__num`")
    categories: dict[str, list[str]] = {}
    for c in categorical:
        mode, texts = found.texts(c)
        categories[c] = list(dict.fromkeys(t or EMPTY for t in texts))
        text = (mode or EMPTY).replace("\\", "\\\\").replace("'", "\\'")
        exprs.append(f"coalesce(if(cast(`{c}` AS STRING) = '', '{EMPTY}', cast(`{c}` AS STRING)), '{text}') AS `{c}__cat`")
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(exprs)} FROM __THIS__")]
    inputs = [f"{c}__num" for c in numeric]
    if categorical:
        names = {end: [f"{c}__{end}" for c in categorical] for end in ("cat", "idx", "hot")}
        # One model per column: an array of lists would be filled up with null labels to the longest one.
        indexers = [StringIndexerModel.from_labels(categories[c], f"{c}__cat", f"{c}__idx", handleInvalid="keep") for c in categorical]
        # The extra index of unseen values is the last one, which dropLast turns into zeros. Sizes come from the columns' metadata.
        none = train.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in names["cat"]))
        encoder = OneHotEncoder(inputCols=names["idx"], outputCols=names["hot"], dropLast=True, handleInvalid="error")
        stages += [*indexers, encoder.fit(PipelineModel(indexers).transform(none))]
        inputs += names["hot"]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    return Preprocessor(PipelineModel(stages), numeric, categorical, categories)
