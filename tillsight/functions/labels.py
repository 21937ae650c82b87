"""Value labels used by the dimensions and facts.

The dictionaries below are the defaults; every operator takes its own mapping
as a parameter, so nothing is tied to one retailer's vocabulary.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: labels that must equal the reference's output ----------
# ISO weekday number (1 = Monday ... 7 = Sunday) -> name.
WEEKDAY_NAMES = {
    1: "Segunda-feira", 2: "Terça-feira", 3: "Quarta-feira", 4: "Quinta-feira",
    5: "Sexta-feira", 6: "Sábado", 7: "Domingo",
}
# Month number -> name.
MONTH_NAMES = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril", 5: "Maio", 6: "Junho",
    7: "Julho", 8: "Agosto", 9: "Setembro", 10: "Outubro", 11: "Novembro",
    12: "Dezembro",
}
PERSON_TYPE_LABELS = {"PF": "Pessoa física", "PJ": "Pessoa jurídica"}
LOCATION_TYPE_LABELS = {"store": "Loja", "warehouse": "Armazém"}
CHANNEL_LABELS = {"pos": "Loja física", "ecommerce": "E-commerce"}
STATUS_LABELS = {"paid": "Pago", "confirmed": "Confirmado",
                 "cancelled": "Cancelado", "draft": "Rascunho"}
REALISED_STATUSES = ("paid", "confirmed")
ACTION_LABELS = {"refund": "Reembolso", "exchange": "Troca"}
# Unknown-member row of the employee dimension.
UNKNOWN_EMPLOYEE = {"employee_id": -1, "employee": "Sem vendedor",
                    "role": "Não aplicável", "is_active": True}
# Return-reason cleaning: values meaning "nothing said", ordered substring
# rules (first match wins) and the default label.
REASON_EMPTY_VALUES = ("", "-", "—", "?", "outros")
REASON_RULES = (
    (("duplicad",), "Compra duplicada"),
    (("desist",), "Cliente desistiu da compra"),
    (("corresp", "descri"), "Item não corresponde à descrição"),
    (("avariad", "transporte"), "Produto avariado no transporte"),
    (("tamanho",), "Tamanho/cor incorretos"),
    (("defeito", "brica"), "Produto com defeito de fábrica"),
)
REASON_DEFAULT = "Não informado"
# Column names that stay text even when every value is a number.
IDENTIFIER_PATTERN = r"(^|_)(cpf|cnpj|tax_id|ncm_code|barcode_ean|postal_code|number)$"
# --- end of fixed values ----------------------------------------------------


def label_of(col: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``; default is the value."""
    out = None
    for key, value in mapping.items():
        out = (F.when(col == F.lit(key), F.lit(value)) if out is None
               else out.when(col == F.lit(key), F.lit(value)))
    fallback = col if default is None else default
    if out is None:
        return fallback
    return out.otherwise(fallback)
