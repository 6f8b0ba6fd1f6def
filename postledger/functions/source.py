"""What the name of a scraped site says about it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import BOARD_TYPE, EMPLOYER_PREFIX, EMPLOYER_TYPE


def with_source(df: DataFrame, column: str = "site") -> DataFrame:
    """Adds ``source_key``, ``source_type`` and ``platform`` of a site.

    The hiring system of one employer carries a prefix, which is not part of the platform.
    """
    site = F.col(column)
    behind = F.substr(site, F.lit(len(EMPLOYER_PREFIX) + 1))
    run_by_employer = F.startswith(site, F.lit(EMPLOYER_PREFIX))
    return df.withColumns({
        "source_key": site,
        "source_type": F.when(run_by_employer, F.lit(EMPLOYER_TYPE)).otherwise(F.lit(BOARD_TYPE)),
        "platform": F.when(run_by_employer, behind).otherwise(site),
    })
