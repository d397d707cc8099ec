"""An ordered classifier whose stages are data: prefixes, maps, patterns and columns, the first that fits decides.

A stage names the column it looks at. The whole cascade is one column expression; maps are literals, since rule files are small.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from playweave.common import path_exists
from playweave.functions import urls

#: Sections of a rule file and their types.
RULE_TYPES = {"private_section_prefixes": list, "section_categories": dict, "section_prefix_categories": dict, "raw_group_categories": dict, "review_raw_groups": list, "channel_name_categories": dict}
MOST_RULES = 5_000


@dataclass
class Stage:
    """kind: `prefix` (data: prefixes; the value itself is the category), `map` (value -> category), `prefix_map` (prefix -> category, in order),
    `pattern` (data: a regular expression, category). `unless` is a pattern on another column that keeps the stage from deciding, `lower` folds the value first."""

    kind: str
    column: str
    data: object
    category: str = ""
    unless: tuple[str, str] | None = None
    lower: bool = False
    only: list[str] = field(default_factory=list)


def _stage(s: Stage, columns: dict[str, Column]) -> Column:
    """Category that a stage decides on, null where it does not fit."""
    value = urls.trimmed(columns[s.column])
    value = F.lower(value) if s.lower else value
    if s.kind == "prefix":
        out = F.lit(None).cast("string")
        for p in s.data:
            out = F.when(F.startswith(value, F.lit(p)), value).otherwise(out)
    elif s.kind == "map":
        out = F.element_at(F.create_map(*(F.lit(x) for kv in s.data.items() for x in kv)), value) if s.data else F.lit(None).cast("string")
    elif s.kind == "prefix_map":
        out = F.lit(None).cast("string")
        for p, category in reversed(s.data.items()):
            out = F.when(F.startswith(value, F.lit(p)), F.lit(category)).otherwise(out)
    elif s.kind == "pattern":
        out = F.when(value.rlike(s.data), F.lit(s.category))
    else:
        raise ValueError(f"no such kind of stage: {s.kind}")
    if s.unless:
        blocked = F.coalesce(columns[s.unless[0]].rlike(s.unless[1]), F.lit(False))
        # Only some of a map's categories may be blocked.
        out = F.when(~(blocked & (out.isin(s.only) if s.only else F.lit(True))), out)
    return out


def cascade(columns: dict[str, Column], stages: list[Stage], default: str) -> Column:
    """Category by the first stage that fits. Null columns fit nothing."""
    return F.coalesce(*(_stage(s, columns) for s in stages), F.lit(default))


def load_rules(spark: SparkSession, path: str) -> dict:
    """A rule file: every section present, of its type; a missing file gives empty rules, a malformed one raises."""
    if not path_exists(spark, path):
        return {k: kind() for k, kind in RULE_TYPES.items()}
    try:
        value = json.loads(spark.read.text(path, wholetext=True).first()[0].lstrip("﻿"))
    except json.JSONDecodeError as e:
        raise ValueError(f"the rule file is no JSON: {e}") from None
    if not isinstance(value, dict):
        raise ValueError("the rule file is no object")
    out = {k: value.get(k, kind()) for k, kind in RULE_TYPES.items()}
    for k, kind in RULE_TYPES.items():
        if not isinstance(out[k], kind):
            raise ValueError(f"{k} in the rule file has the wrong type")
        if len(out[k]) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} rules in {k}")
    return out


def stages_of(rules: dict, names: list[Stage], groups: list[Stage], kept_local: tuple[str, list[str]] | None = None) -> list[Stage]:
    """The order of a channel classifier: private sections and groups, names by map, names by pattern, sections, raw groups, groups by pattern.

    kept_local: a pattern of names for which the raw groups' categories in a list don't count.
    """
    private = rules["private_section_prefixes"]
    raw = Stage("map", "group", rules["raw_group_categories"], unless=("name", kept_local[0]) if kept_local else None, only=kept_local[1] if kept_local else [])
    return [
        Stage("prefix", "section", private), Stage("prefix", "group", private), Stage("map", "name", rules["channel_name_categories"], lower=True), *names,
        Stage("map", "section", rules["section_categories"]), Stage("prefix_map", "section", rules["section_prefix_categories"]), raw, *groups,
    ]
