"""Host and URI expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Host patterns. The default has bare dots (any character), the strict one literal dots.
HOST_PATTERN = r"((^[0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}$)|([\w]*?.[\w]+?.[\w]+?$))"
HOST_PATTERN_STRICT = r"((^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$)|([\w]*?\.[\w]+?\.[\w]+?$))"

# Characters that become words of their own in a tokenised URI.
URI_SEPARATORS = r"([/=?%.\-_&:'(),|*+;])"


def normalize_host(host: Column, strict: bool = False) -> Column:
    """IPv4 literal or the last labels of a host; '' when nothing matches."""
    return F.regexp_extract(host, HOST_PATTERN_STRICT if strict else HOST_PATTERN, 1)


def decode_uri(uri: Column) -> Column:
    """Percent-decoded URI; null when it cannot be decoded."""
    return F.when(uri.contains("%"), F.try_url_decode(uri)).otherwise(uri)


def spaced_uri(decoded: Column) -> Column:
    """Blanks around every separator, one leading blank dropped."""
    spaced = F.regexp_replace(decoded, URI_SEPARATORS, " $1 ")
    return F.regexp_replace(spaced, "^ ", "")


def tokenize_uris(df: DataFrame, uri: str = "uri", out: str = "urltext") -> DataFrame:
    """Rows whose decoded URI carries a query, with the spaced text; other rows vanish."""
    decoded = df.withColumn(uri, decode_uri(F.col(uri)))
    return decoded.where(F.col(uri).contains("?") & F.col(uri).contains("=")).withColumn(out, spaced_uri(F.col(uri)))
