"""Column-expression helpers shared by the operators (all JVM-side)."""

from tillsight.functions.labels import label_of  # noqa: F401
from tillsight.functions.numeric import half_up_div, mean_half_up, money  # noqa: F401
from tillsight.functions.text import categorise, changed, normalise_key  # noqa: F401
