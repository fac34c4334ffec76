"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL stand-in of the published key macro.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the dash-joined parts, NULL parts replaced by a stand-in.

    A pure function of the natural key, so foreign keys can be computed in place instead of
    being looked up through a join.
    """
    texts = [F.coalesce(part.cast("string"), F.lit(KEY_NULL)) for part in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))
