"""The Python functions under names that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, StringType

from corpusloom.convert import eqedit_script, equation_to_latex
from corpusloom.functions.html import page_to_markdown
from corpusloom.functions.pages import call_arguments


def register(spark: SparkSession) -> list[str]:
    """Registers the functions that are no built-ins and returns their names."""
    import pandas as pd
    from pyspark.sql import functions as F

    vectorized = lambda f: F.pandas_udf(lambda s: pd.Series([f(x) for x in s], dtype=object), StringType())
    found = {
        "html_to_markdown": vectorized(page_to_markdown),
        "equation_to_latex": vectorized(equation_to_latex),
        "eqedit_script": vectorized(eqedit_script),
        "js_arguments": F.pandas_udf(lambda s: pd.Series([call_arguments(x) for x in s], dtype=object), ArrayType(StringType())),
    }
    for name, function in found.items():
        spark.udf.register(name, function)
    return list(found)
