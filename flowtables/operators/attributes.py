"""Attribute projection, JSON headers and their decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions import headers
from flowtables.schema import CORE_ATTRIBUTES, ERROR, SUCCESS


def _listed_names(names: str | None, include_core: bool) -> list[str] | None:
    if names is None or not names.strip():
        return None
    trimmed = (n.strip() for n in names.split(",") if n)
    excluded = () if include_core else CORE_ATTRIBUTES
    return sorted({n for n in trimmed if n not in excluded})


def selected_attributes(
    attributes: Column,
    names: str | None = None,
    regex: str | None = None,
    include_core: bool = True,
    null_for_missing: bool = False,
) -> Column:
    """Column form of :func:`select_attributes`."""
    listed = _listed_names(names, include_core)
    if listed is None and regex is None:
        if include_core:
            return attributes
        return F.map_filter(attributes, lambda k, _: ~k.isin(*CORE_ATTRIBUTES))

    def whole_key(key: Column) -> Column:
        return key.rlike(rf"\A(?:{regex})\z") if regex is not None else F.lit(False)

    chosen = F.map_filter(attributes, lambda k, _: whole_key(k))
    if listed:
        # Listed keys come from the list alone, so the two maps share no key.
        names_array = F.array(*map(F.lit, listed))
        missing = F.lit(None).cast("string") if null_for_missing else F.lit("")
        values = F.transform(names_array, lambda n: F.coalesce(F.element_at(attributes, n), missing))
        others = F.map_filter(chosen, lambda k, _: ~k.isin(*listed))
        chosen = F.map_concat(F.map_from_arrays(names_array, values), others)
    return chosen


def select_attributes(
    flows: DataFrame,
    names: str | None = None,
    regex: str | None = None,
    include_core: bool = True,
    null_for_missing: bool = False,
    include_attributes: bool = True,
) -> DataFrame:
    """O9. Choose the attributes to transfer.

    ``names`` is a comma separated list; a listed name that a flow lacks becomes ``""`` (or null).
    ``regex`` adds every attribute whose whole name matches, core names included. Without either,
    all attributes go, less the core ones if ``include_core`` is false. ``include_attributes=False``
    sends none (a header of length 0).
    """
    if not include_attributes:
        return flows.withColumn("attributes", F.lit(None).cast("map<string,string>"))
    chosen = selected_attributes(F.col("attributes"), names, regex, include_core, null_for_missing)
    return flows.withColumn("attributes", chosen)


def encode_attributes(flows: DataFrame, typed: bool = False, text_regex: str | None = None) -> DataFrame:
    """O10. Add ``header_json`` and ``header_len``; flows without attributes have no header (length 0).

    ``typed`` writes values as the JSON they parse to, as older senders do; those take the values they selected by
    a regular expression as text all the same, which ``text_regex`` says.
    """
    attributes = F.col("attributes")
    text = headers.typed_header_text(attributes, text_regex) if typed else headers.header_text(attributes)
    if typed:
        text = F.when(attributes.isNotNull(), F.coalesce(text, F.lit("{}")))
    with_text = flows.withColumn("header_json", text)
    return with_text.withColumn("header_len", F.coalesce(F.octet_length("header_json"), F.lit(0)))


def type_attributes(flows: DataFrame) -> DataFrame:
    """O11. Add ``typed``: attribute name -> JSON text of the value (number, boolean, object ... or string)."""
    return flows.withColumn("typed", F.transform_values("attributes", lambda _, v: headers.typed_value_json(v)))


def decode_attributes(df: DataFrame, header_col: str) -> DataFrame:
    """O12. Add ``attributes`` and ``outcome``; a header that is no JSON object gives an error row."""
    decoded = df.withColumn("attributes", headers.header_attributes(F.col(header_col)))
    outcome = F.when(F.col(header_col).isNotNull() & F.col("attributes").isNull(), ERROR).otherwise(SUCCESS)
    return decoded.withColumn("outcome", outcome)


def add_endpoint_attributes(
    df: DataFrame, sender: Column | str, receiver: Column | str, port: Column | int, local_ip: Column | str = None, compat: bool = False
) -> DataFrame:
    """O13. Add sender, receiver and port attributes to flows that have at least one attribute.

    ``compat=True`` writes the receiving side's own address (``local_ip``) as the sender, as the
    older receivers do.
    """

    def value(v) -> Column:
        return (v if isinstance(v, Column) else F.lit(v)).cast("string")

    endpoint = {
        "tcp.sender": value(local_ip if compat else sender),
        "tcp.receiver": value(receiver),
        "tcp.receiver_port": value(port),
    }
    attributes = F.col("attributes")
    kept = F.map_filter(attributes, lambda k, _: ~k.isin(*endpoint))
    added = F.create_map(*(c for k, v in endpoint.items() for c in (F.lit(k), v)))
    return df.withColumn(
        "attributes", F.when(F.size(attributes) > 0, F.map_concat(kept, added)).otherwise(attributes)
    )


def attributes_long(flows: DataFrame, keep: tuple[str, ...] = ("flow_id",)) -> DataFrame:
    """O14. One row per flow and attribute."""
    return flows.select(*keep, F.explode("attributes").alias("key", "value"))
