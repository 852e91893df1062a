"""Tree report (R32): per reachable node its subtree size, its share among
its siblings (roots are one sibling group), and its indented full path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import indent
from ..operators.tree import subtree_totals, walk_from_roots
from ..operators.windows import ratio_to_report


def tree_report(file_system: DataFrame, sep: str = "\\") -> DataFrame:
    walked = walk_from_roots(file_system, sep=sep, carry=("type", "file_size"))
    sized = subtree_totals(walked, "file_size", "dir_size")
    shared = ratio_to_report(sized, "dir_size", ["parent_id"], "dir_ratio")
    return (shared.select("id", "dir_size", "type", "parent_id", "dir_ratio",
                          F.concat(indent("level"), F.col("path")).alias("full_name"))
            .orderBy("id"))
