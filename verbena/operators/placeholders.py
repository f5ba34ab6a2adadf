"""Order of placeholders in item names: an ordered list of cases, the first that holds decides.

English puts themes and qualities before a name, Portuguese after it. Each case is a pattern
and what becomes of the value; the list becomes one CASE expression.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: The families of placeholders.
QUALITY = r"\{EffectFoodCommon\.Food_(?:Perfect|Delicious|Normal)\}"
FOOD = r"\{EffectFoodCommon\.[^{}]+\}"
BROOM_NAME = r"\{BroomstickCommon\.Broomstick_Name\}"
BROOM_TYPE = r"\{BroomstickCommon\.Broomstick_Type_[^{}]+\}"
BROOM_THEME = r"\{BroomstickTheme\.[^{}]+\}"
PROP_NAME = r"\{InteriorPropBasicName\.[^{}]+\}"
PROP_THEME = r"\{InteriorPropTheme\.[^{}]+\}"
REFERENCE = r"\{(?:People|CreatureName|PotionName|CandyName)\.[^{}]+\}"


class Case(NamedTuple):
    """A case: pattern, reason if the value stays, and how it changes and why, if it does."""

    pattern: str
    unchanged: str
    order: str | None = None
    changed: str | None = None
    unless: str | None = None
    #: Whether group 1 holds placeholders in a row, put behind with one space between them.
    row: bool = False


#: The cases in their order. `order` names groups of the pattern.
CASES = (
    Case(r"^\{EffectFoodCommon\.[^{}]*_Description\}$", "effectfood_descricao_nao_alterada"),
    Case(rf"^.+?\s+{QUALITY}$", "ja_estava_correto_effectfood_nome_qualidade", unless=r"^\{EffectFoodCommon\.Food_"),
    Case(rf"^({QUALITY})\s+(.+?)$", "sem_mudanca_effectfood", "$2 $1", "effectfood_qualidade_movida_para_o_final", r"^\S+\s+.*_Description\}|\n|\\n"),
    Case(r"^\{BroomstickTheme\.[^{}]+_Description\}\\n\{BroomstickCommon\.Broomstick_Type_[^{}]+_Description\}$", "broomstick_descricao_composta_nao_alterada"),
    Case(rf"^{BROOM_NAME}\s+{BROOM_THEME}\s+{BROOM_TYPE}$", "ja_estava_correto_broomstick_nome_theme_tipo"),
    Case(rf"^{BROOM_NAME}\s+{BROOM_THEME}$", "ja_estava_correto_broomstick_nome_theme"),
    Case(rf"^({BROOM_TYPE})\s+({BROOM_THEME})\s+({BROOM_NAME})$", "sem_mudanca_broomstick_tipo_theme_nome", "$3 $2 $1", "broomstick_tipo_theme_nome_corrigido_para_nome_theme_tipo"),
    Case(rf"^({BROOM_THEME})\s+({BROOM_NAME})$", "sem_mudanca_broomstick_theme_nome", "$2 $1", "broomstick_theme_nome_corrigido_para_nome_theme"),
    Case(rf"\{{Fish(?:Name|Grade)\.[^{{}}]+\}}.*{PROP_NAME}", "fish_com_interiorprop_nao_alterado"),
    Case(rf"^{PROP_NAME}\s+de\s+{REFERENCE}$", "ja_estava_correto_interiorbasic_de_referencia"),
    Case(rf"^({REFERENCE})\s+({PROP_NAME})$", "sem_mudanca_referencia", "$2 de $1", "referencia_antes_interiorbasic_corrigida_com_de"),
    Case(rf"(?s)^({PROP_THEME}(?:\s*{PROP_THEME})*)\s*(.+)$", "sem_mudanca_interiorprop_theme", "$2 $1", "interiorprop_theme_movido_para_o_final", rf"^(?:\s*{PROP_THEME})+$", True),
    Case(rf"^(.+?)\s+({PROP_NAME})$", "sem_mudanca_texto_antes_interiorbasic", "$2 de $1", "texto_antes_interiorbasic_corrigido_com_de", r"\{Fish(?:Name|Grade)\.|^\{InteriorProp(?:BasicName|Theme)\."),
    Case(rf"(?s)^({BROOM_THEME}(?:\s*{BROOM_THEME})*)\s*(.+)$", "sem_mudanca_broomstick_theme_generico", "$2 $1", "broomstick_theme_movido_para_o_final_generico", rf"_Description\}}|^(?:\s*{BROOM_THEME})+$", True),
    Case(QUALITY, "effectfood_qualidade_existe_mas_nao_entrou_nas_regras"),
    Case(FOOD, "tem_effectfood_mas_nao_entrou_nas_regras"),
    Case(PROP_THEME, "interiorprop_theme_existe_mas_nao_esta_no_inicio"),
    Case(r"\{InteriorProp(?:Theme|BasicName)\.[^{}]+\}", "tem_interiorprop_mas_nao_entrou_nas_regras"),
    Case(BROOM_THEME, "broomstick_theme_existe_mas_nao_entrou_nas_regras"),
    Case(r"\{Broomstick(?:Theme|Common)\.[^{}]+\}", "tem_broomstick_mas_nao_entrou_nas_regras"),
)


def reordered(value: Column) -> Column:
    """A struct of new value, changed and reason."""
    return T.let(F.struct(value.alias("v"), T.ws_trim(value).alias("c")), lambda x: _decided(x["v"], x["c"]))


def _decided(value: Column, core: Column) -> Column:
    case = F.when(value.isNull(), _result(value, value, "valor_nao_string", None)).when(core == "", _result(value, value, "valor_vazio", None))
    for c in CASES:
        holds = core.rlike(c.pattern)
        if c.unless:
            holds = holds & ~core.rlike(c.unless)
        new = value
        if c.row:
            first, rest = (F.regexp_extract(core, c.pattern, i) for i in (1, 2))
            new = T.squeeze(F.concat_ws(" ", rest, F.regexp_replace(first, r"\}\s*\{", "} {")))
        elif c.order:
            new = T.squeeze(F.regexp_replace(core, c.pattern, c.order))
        case = case.when(holds, _result(value, new, c.unchanged, c.changed))
    return case.otherwise(_result(value, value, "sem_placeholder_relevante", None))


def _result(old: Column, new: Column, unchanged: str, changed: str | None) -> Column:
    moved = (new != old) if changed else F.lit(False)
    return F.struct(new.alias("value"), F.coalesce(moved, F.lit(False)).alias("changed"), (F.when(moved, changed).otherwise(unchanged) if changed else F.lit(unchanged)).alias("reason"))


def reason_counts(df: DataFrame, value_col: str) -> DataFrame:
    return df.select(F.explode(F.array(reordered(F.col(value_col)))).alias("r")).groupBy("r.reason").agg(F.count("*").alias("n"), F.count_if("r.changed").alias("changed"))
