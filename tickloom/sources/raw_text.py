"""Landed text records: comma-packed flow lines and positional quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.scalar import parse_date, parse_num

# Position of each field in a flow line; position 0 is the date.
FLOW_FIELDS = {
    1: "main_net_amount",
    2: "small_net_amount",
    3: "medium_net_amount",
    4: "large_net_amount",
    5: "xlarge_net_amount",
    6: "main_net_ratio",
    7: "small_net_ratio",
    8: "medium_net_ratio",
    9: "large_net_ratio",
    10: "xlarge_net_ratio",
    11: "close",
    12: "change_pct",
}
FLOW_MIN_FIELDS = 13

# Position of each field in a quote record.
QUOTE_FIELDS = {
    3: "close",
    4: "prev_close",
    5: "open",
    6: "volume",
    7: "outer_vol",
    8: "inner_vol",
    9: "buy1_vol",
    11: "buy1_price",
    30: "quote_time",
    31: "change",
    32: "change_pct",
    33: "high",
    34: "low",
    37: "amount",
    38: "turnover",
    39: "pe_ttm",
    43: "amplitude",
    44: "circ_mv",
    45: "total_mv",
    46: "pb",
    47: "high_limit",
    48: "low_limit",
    49: "volume_ratio",
}
QUOTE_MIN_FIELDS = 50


def flow_lines(payloads: DataFrame, symbol: str = "stock_code", body: str = "payload") -> DataFrame:
    """One row per line of ``{"data": {"klines": [...]}}``; payloads without lines give none."""
    parsed = f"from_json({body}, 'data struct<klines: array<string>>')"
    return payloads.selectExpr(f"{symbol} AS stock_code", f"explode({parsed}.data.klines) AS line")


def flow_variants(payloads: DataFrame, symbol: str = "stock_code", body: str = "payload") -> DataFrame:
    """Flow rows from payloads whose shape has drifted: lines of fields, or objects with named fields.

    A payload is parsed to a VARIANT, so neither shape has to be declared and nothing of a record is lost:
    ``record`` is the object (or the line) with the fields no column takes, for :func:`record_field`.
    Payloads that are no JSON, and records of neither shape, come back with a ``reject_reason``.
    """
    parsed = payloads.selectExpr(f"{symbol} AS stock_code", f"{body} AS _body", f"try_parse_json({body}) AS _payload")
    lines = parsed.selectExpr("*", "try_variant_get(_payload, '$.data.klines', 'array<variant>') AS _records")
    names = {"trade_date": 0, **{n: i for i, n in FLOW_FIELDS.items()}}
    # The texts of a record are taken before the records become rows: a filter on the parsed columns moves down to
    # there as an expression and would take them once for each of its fields otherwise.
    fields = ", ".join(record_field(n, "r") for n in names)
    line = "split(variant_get(r, '$', 'string'), ',')"
    texts = f"transform(_records, r -> named_struct('record', r, 'texts', if(schema_of_variant(r) = 'STRING', {line}, array({fields}))))"
    exploded = lines.selectExpr("stock_code", "_body", "_payload IS NULL AS _broken", f"explode_outer({texts}) AS _taken")
    rows = exploded.selectExpr("stock_code", "_body", "_broken", "_taken.record", "_taken.texts AS _texts")

    def value(column: str, at: int) -> str:
        read = parse_date if column == "trade_date" else parse_num
        return f"{read(f'get(_texts, {at})')} AS {column}"

    typed = rows.selectExpr("stock_code", "_body", "_broken", "record", *(value(c, at) for c, at in names.items()))
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    reason = f"CASE WHEN _broken THEN 'no JSON' WHEN record IS NULL THEN 'no records' WHEN NOT ({known}) THEN 'unreadable record' END"
    return typed.selectExpr(
        "stock_code", *names, "record", f"{reason} AS reject_reason", f"if(_broken OR record IS NULL, _body, NULL) AS payload"
    )


def record_field(field: str, record: str = "record") -> str:
    """The text of any field of a record that is an object; NULL where it has none, and for a record that is no object."""
    return f"try_variant_get({record}, '$.{field}', 'string')"


def _flow_parts(lines: DataFrame) -> DataFrame:
    # Made a row's value by a generator: a filter on the parsed fields does not take the split along, once for each field.
    parts = lines.selectExpr("stock_code", "line", "explode(array(split(line, ','))) AS parts")
    rows = parts.selectExpr(
        "stock_code",
        "line",
        "size(parts) AS field_count",
        f"{parse_date('get(parts, 0)')} AS trade_date",
        *(f"{parse_num(f'get(parts, {i})')} AS {n}" for i, n in FLOW_FIELDS.items()),
    )
    known = " AND ".join(f"{n} IS NOT NULL" for n in ("trade_date", *FLOW_FIELDS.values()))
    return rows.selectExpr("*", f"field_count >= {FLOW_MIN_FIELDS} AND {known} AS good")


def parse_flow(lines: DataFrame) -> DataFrame:
    """Typed flow rows from (stock_code, line); lines that do not parse are left out."""
    good = _flow_parts(lines).where("good")
    return good.select("stock_code", "trade_date", *FLOW_FIELDS.values())


def rejected_flow(lines: DataFrame) -> DataFrame:
    """The lines ``parse_flow`` leaves out, with the reason."""
    reason = f"if(field_count < {FLOW_MIN_FIELDS}, 'too_few_fields', 'unparsable')"
    bad = _flow_parts(lines).where("NOT good")
    return bad.selectExpr("stock_code", "line", f"{reason} AS reason")


def parse_quotes(records: DataFrame, body: str = "record") -> DataFrame:
    """Typed quote rows. Records too short, or without PE and PB, are left out."""

    def field(i: int, column: str) -> str:
        text = f"get(parts, {i})"
        value = f"nullif(trim({text}), '')" if column == "quote_time" else parse_num(text)
        return f"{value} AS {column}"

    parts = records.selectExpr("stock_code", f"split({body}, '~') AS parts")
    rows = parts.where(f"size(parts) >= {QUOTE_MIN_FIELDS}").selectExpr(
        "stock_code", *(field(i, c) for i, c in QUOTE_FIELDS.items())
    )
    return rows.where("coalesce(pe_ttm, pb) IS NOT NULL")


def quote_valuation(quotes: DataFrame, as_of: str) -> DataFrame:
    """Valuation updates of one day from parsed quotes."""
    return quotes.selectExpr("stock_code", f"date'{as_of}' AS trade_date", "pe_ttm", "pb")
