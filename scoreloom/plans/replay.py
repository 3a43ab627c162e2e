"""What scoring and testing share: read a learn folder, replay its preparation."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from scoreloom.operators.audit import audit_id, audit_label, require
from scoreloom.operators.clean import as_categories, drop_variables, fill_missing
from scoreloom.operators.training import read_json
from scoreloom.operators.woe import apply_level_codes
from scoreloom.sources import delimited, tables


@dataclass
class Replay:
    algorithm: str
    model_path: str
    types: dict[str, str]
    removed: list[str]
    fill: dict[str, object]
    id_name: str | None
    target_name: str | None
    separator: str = ","
    missing: list[str] = field(default_factory=lambda: list(delimited.MISSING_SPELLINGS))
    level_codes_path: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


def from_learn_folder(spark: SparkSession, folder: str) -> Replay:
    folder = folder.rstrip("/")
    config = read_json(spark, folder + "/learn_configuration.json")
    prep = read_json(spark, folder + "/learn_preprocess.json")
    return Replay(config["algorithm"], config["model_path"], prep["types"], prep["removed"],
                  prep["fill"], prep["id_name"], prep["target_name"], config["separator"],
                  config["missing"], folder + "/level_codes" if prep["level_codes"] else None)


def from_act_folder(spark: SparkSession, folder: str) -> Replay:
    return Replay(**read_json(spark, folder.rstrip("/") + "/act_config.json"))


def import_data(spark: SparkSession, replay: Replay, *, df: DataFrame | None = None,
                table: str | None = None, path: str | None = None,
                need_target: bool = False) -> DataFrame:
    """Read with the learned types, separator and missing spellings; audit the id
    and, where it is needed, the label. The target may be absent otherwise.
    """
    types = dict(replay.types)
    if df is None and table:
        df = tables.read_table(spark, table)
    if df is None:
        have = spark.read.option("sep", replay.separator).option("header", True).csv(path).columns
    else:
        have = df.columns
    if replay.target_name and replay.target_name not in have and not need_target:
        types.pop(replay.target_name)
    if df is None:
        typed = delimited.read_declared(spark, path, types, replay.separator, missing=replay.missing,
                                        id_name=replay.id_name)
    else:
        typed = tables.as_declared(df, types, replay.id_name)
    audits = []
    if replay.id_name:
        audits.append(audit_id(typed, replay.id_name))
    if need_target and replay.target_name:
        audits.append(audit_label(typed, replay.target_name))
    require(*audits)
    target = replay.target_name if replay.target_name in types else None
    return as_categories(typed, replay.id_name, target)


def prepare(spark: SparkSession, df: DataFrame, replay: Replay) -> DataFrame:
    """The learned drop list, fill values and level codes."""
    out = fill_missing(drop_variables(df, replay.removed), replay.fill)
    if replay.level_codes_path:
        codes = spark.read.parquet(replay.level_codes_path)
        coded = [r[0] for r in codes.select("variable").distinct().collect()]
        out = apply_level_codes(out, codes, coded)
    return out
