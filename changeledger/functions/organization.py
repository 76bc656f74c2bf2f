"""Organisation from an email address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These two patterns decide the organisation. In the second one the character
# before the top-level domain is any character, not only a dot.
DOMAIN_WITHOUT_EXTENSION = r"\A(.*?)@([^.]+)\z"
DOMAIN_WITH_EXTENSION = r"\A(.*?)@(.*?)(?:\.co)?.[a-z]{2,4}\z"


def organization_of(email: Column) -> Column:
    """Domain without its extension, lower-cased; '' when the address does not look like one."""
    lowered = F.lower(email)
    return (
        F.when(lowered.rlike(DOMAIN_WITHOUT_EXTENSION), F.regexp_extract(lowered, DOMAIN_WITHOUT_EXTENSION, 2))
        .when(lowered.rlike(DOMAIN_WITH_EXTENSION), F.regexp_extract(lowered, DOMAIN_WITH_EXTENSION, 2))
        .otherwise(F.lit(""))
    )
