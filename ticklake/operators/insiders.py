"""Insider filings (Forms 3/4/5): header coercions, ledger rows, positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import latest_by


def position_current(ledger: DataFrame, filing: DataFrame) -> DataFrame:
    """Latest known position per (ticker, insider, security, derivative flag).

    Only completed filings and lines with a holdings figure count.  Latest =
    transaction_date DESC NULLS LAST, then filing id DESC, then line DESC.
    """
    done = filing.where(F.col("completed")).select(F.col("id").alias("insider_filing_id"))
    lines = ledger.where(F.col("shares_owned_following").isNotNull()).join(done, "insider_filing_id")
    extra = [c for c in ("ownership", "ownership_nature") if c in ledger.columns]
    payload = ["security_title", "shares_owned_following", "transaction_date", "insider_filing_id", *extra]
    out = latest_by(
        lines,
        ["ticker_id", "insider_id", F.coalesce(F.col("security_title"), F.lit("")), "is_derivative"],
        [F.col("transaction_date"), F.col("insider_filing_id"), F.col("line_number")],
        payload,
    )
    return out.select(
        "ticker_id", "insider_id", "security_title", "is_derivative",
        F.col("shares_owned_following").alias("shares_held"),
        F.col("transaction_date").alias("as_of_date"),
        "insider_filing_id", *extra,
    )


# --- header, ledger rows, dimension resolution ----------------------------------
from pyspark.sql import Window  # noqa: E402

from ..functions import coerce as C  # noqa: E402
from .. import schemas  # noqa: E402
from .common import dense_ids  # noqa: E402


def insider_header(raw: DataFrame, today) -> DataFrame:
    """P16 + P17: header fields of an ownership filing.

    filing_date <- filing date, else reporting period, else ``today``;
    insider_name <- summary name, else filing name, else first owner's name,
    else 'Unknown Insider'; form_type with 'Form' removed; is_amendment.
    """
    owner = F.get(F.col("owners"), 0) if "owners" in raw.columns else F.lit(None)
    fields = raw.schema["owners"].dataType.elementType.names if "owners" in raw.columns else []
    owner_name = owner.getField("name") if "name" in fields else F.lit(None).cast("string")
    name_cols = [C.clean_text(c) for c in ("summary_insider_name", "insider_name") if c in raw.columns]
    fd = C.to_date10("filing_date_raw")
    rp = C.to_date10("reporting_period_raw") if "reporting_period_raw" in raw.columns else F.lit(None).cast("date")
    form = C.form_type("form_raw")
    return raw.select(
        "id", "accession_no",
        form.alias("form_type"),
        C.is_amendment(form).alias("is_amendment"),
        F.coalesce(fd, rp, F.lit(today).cast("date")).alias("filing_date"),
        rp.alias("reporting_period"),
        F.coalesce(*name_cols, C.clean_text(owner_name), F.lit("Unknown Insider")).alias("insider_name"),
        *_owner_columns(raw, owner, fields),
    )


def _owner_columns(raw: DataFrame, owner, fields) -> list:
    """The optional header columns that the input can tell: position (summary,
    else owner), the owner's roles, title and the trading-plan flag."""
    out = []
    position = [C.clean_text("position")] if "position" in raw.columns else []
    if "position" in fields:
        position.append(C.clean_text(owner.getField("position")))
    if position:
        out.append(F.coalesce(*position).alias("position"))
    out += [owner.getField(f).alias(f) for f in ("is_director", "is_officer", "is_ten_pct_owner") if f in fields]
    if "officer_title" in fields:
        out.append(C.clean_text(owner.getField("officer_title")).alias("officer_title"))
    if "has_10b5_1_plan" in raw.columns:
        out.append(F.col("has_10b5_1_plan"))
    return out


def number_rows(df: DataFrame, keys, order, name: str = "line_number") -> DataFrame:
    """1-based numbering inside each key in source order (small groups)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def ledger_rows(raw: DataFrame, filing_key: str = "filing_id", order_col: str = "src_order") -> DataFrame:
    """Ownership-table rows -> ledger lines.

    A frame that carries a security-type column is a Form 3 holdings frame
    (``has_security_type`` per row when frames are mixed in one table): its code
    is 'H' and the holding is the underlying amount for derivatives, else the
    share amount.  A line is derivative when its security type mentions
    'derivative'.  Ownership 'Direct'/'Indirect' -> 'D'/'I'.
    """
    cols = raw.columns
    if "has_security_type" in cols:
        holding = F.coalesce(F.col("has_security_type"), F.lit(False))
    else:
        holding = F.lit("security_type" in cols)
    sec_type = C.clean_text("security_type") if "security_type" in cols else F.lit(None).cast("string")
    # read more than once below: parsed once, in a projection of their own
    is_deriv, shares, under = F.col("_derivative"), F.col("_shares"), F.col("_underlying")
    numbered = number_rows(raw, [filing_key], [F.col(order_col)]).withColumns({
        "_derivative": F.coalesce(F.lower(sec_type).contains("derivative"), F.lit(False)),
        "_shares": C.to_dec("shares"),
        "_underlying": C.to_dec("underlying_shares") if "underlying_shares" in cols else F.lit(None).cast("decimal(20,4)")})

    def nonblank(c):
        return F.when(F.col(c) != "", F.col(c)) if c in cols else F.lit(None).cast("string")

    title = F.coalesce(nonblank("security_title"), nonblank("security"),
                       F.when(~holding, F.lit("Common Stock")), nonblank("transaction_type"))
    own = F.col("ownership_type") if "ownership_type" in cols else F.lit(None).cast("string")
    following = F.when(holding, F.when(is_deriv, under).otherwise(shares)).otherwise(
        C.to_dec("remaining_shares") if "remaining_shares" in cols else F.lit(None).cast("decimal(20,4)"))
    return numbered.select(
        F.col(filing_key).alias("insider_filing_id"),
        "line_number",
        C.to_date10("date").alias("transaction_date"),
        C.clean_text(title).alias("security_title"),
        F.coalesce(C.clean_text("code") if "code" in cols else F.lit(None).cast("string"),
                   F.when(holding, F.lit("H"))).alias("transaction_code"),
        C.clean_text("transaction_type").alias("transaction_label") if "transaction_type" in cols
        else F.lit(None).cast("string").alias("transaction_label"),
        shares.alias("shares"),
        C.to_dec("price").alias("price_per_share") if "price" in cols
        else F.lit(None).cast("decimal(20,4)").alias("price_per_share"),
        F.when(own == "Direct", "D").when(own == "Indirect", "I").alias("ownership"),
        following.alias("shares_owned_following"),
        is_deriv.alias("is_derivative"),
        under.alias("underlying_shares"),
        F.coalesce(C.clean_text("form") if "form" in cols else F.lit(None).cast("string"), F.lit("")).alias("form_label"),
    )


# FIXED VALUES: column names of the vendor's transaction tables
LEDGER_ALIASES = {
    # output column: (alias names in order, kind)
    "transaction_date": (("date", "transaction_date"), "date"),
    "security_title": (("security", "security_title"), "text"),
    "transaction_code": (("transaction_code", "code"), "text"),
    "transaction_label": (("transaction_type", "display_name"), "text"),
    "transaction_description": (("code_description", "description"), "text"),
    "acquired_disposed": (("acquired_disposed", "acquired_disposed_code"), "text"),
    "shares": (("shares", "shares_numeric"), "dec"),
    "price_per_share": (("price", "price_per_share", "price_numeric"), "dec"),
    "transaction_value": (("value", "value_numeric"), "dec"),
    "ownership": (("direct_indirect", "ownership"), "text"),
    "ownership_nature": (("nature_of_ownership", "ownership_nature"), "text"),
    "shares_owned_following": (("remaining", "shares_owned_following_transaction", "shares_owned_following"), "dec"),
    "exercise_price": (("exercise_price",), "dec"),
    "expiration_date": (("expiration_date",), "date"),
    "underlying_security_title": (("underlying_security", "underlying_security_title"), "text"),
    "underlying_shares": (("underlying_shares",), "dec"),
    "is_10b5_1": (("is_10b5_1_plan",), "raw"),
    "footnotes": (("footnotes", "footnotes_text"), "text"),
}


def ledger_rows_alias(raw: DataFrame, is_derivative: bool, filing_key: str = "filing_id",
                      order_col: str = "src_order") -> DataFrame:
    """Ledger lines from an attribute-named transaction table (P15 per column)."""
    numbered = number_rows(raw, [filing_key], [F.col(order_col)])
    out = [F.col(filing_key).alias("insider_filing_id"), F.col("line_number")]
    for name, (aliases, kind) in LEDGER_ALIASES.items():
        v = C.first_of(numbered, *aliases)
        if kind == "date":
            v = C.to_date10(v)
        elif kind == "text":
            v = C.clean_text(v)
        elif kind == "dec":
            v = C.to_dec(v)
        else:
            v = v.cast("string")
        out.append(v.alias(name))
    out.append(F.lit(is_derivative).alias("is_derivative"))
    return numbered.select(*out)


def resolve_insiders(insider: DataFrame, incoming: DataFrame) -> DataFrame:
    """Get-or-create insiders with a nullable natural key.

    With a cik: match on cik and refresh the name (last incoming name wins by
    ``seq`` when given); without: match on (cik IS NULL, name).  New insiders get
    ids ``max(id) + rank`` in natural-key order.  Returns the new dimension.
    """
    nk = natural_key()
    inc = incoming.where(F.col("cik").isNotNull() | F.col("name").isNotNull()).withColumn("_nk", nk)
    order = [F.col("seq")] if "seq" in inc.columns else [F.col("name")]
    inc = latest_by(inc, ["_nk"], order, ["cik", "name"])
    cur = insider.withColumn("_nk", nk)
    # existing rows, names refreshed for cik matches
    upd = inc.where(F.col("cik").isNotNull()).select("_nk", F.col("name").alias("_new_name"))
    kept = cur.join(upd, "_nk", "left").select(
        "id", "cik", F.coalesce(F.col("_new_name"), F.col("name")).alias("name"))
    new = inc.join(cur.select("_nk"), "_nk", "left_anti")
    max_id = insider.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    fresh = dense_ids(new.select("_nk", "cik", "name"), ["_nk"], max_id).select("id", "cik", "name")
    return kept.unionByName(fresh)


def natural_key(cik="cik", name="name"):
    """How an insider is recognised: by cik, without one by name."""
    return F.when(F.col(cik).isNotNull(), F.concat(F.lit("c:"), F.col(cik))).otherwise(F.concat(F.lit("n:"), F.col(name)))


def filing_insiders(incoming: DataFrame, insider: DataFrame) -> DataFrame:
    """(filing_id, insider_id): the owner named on each filing, resolved."""
    known = insider.select(natural_key().alias("_nk"), F.col("id").alias("insider_id"))
    return incoming.select("filing_id", natural_key().alias("_nk")).join(known, "_nk").select("filing_id", "insider_id")


def with_direction(ledger: DataFrame) -> DataFrame:
    """``acquired_disposed`` where the vendor gave none: a purchase (code P) is
    acquired, a sale (code S) disposed."""
    code = F.col("transaction_code")
    told = F.col("acquired_disposed") if "acquired_disposed" in ledger.columns else F.lit(None).cast("string")
    return ledger.withColumn("acquired_disposed", F.coalesce(told, F.when(code == "P", "A").when(code == "S", "D")))


def with_code_labels(ledger: DataFrame, codes: DataFrame) -> DataFrame:
    """Ledger lines with code label/description; unseen codes are added to
    the code table as 'Other (X)' first (insert-ignore), then a left join.  The
    codes come from the data, so the join is left to Spark's size estimate."""
    seen = ledger.where(F.col("transaction_code").isNotNull()).select(
        F.col("transaction_code").alias("code")).distinct()
    other = F.concat(F.lit("Other ("), F.col("code"), F.lit(")"))
    missing = seen.join(codes.select("code"), "code", "left_anti").select(
        "code", other.alias("label"), other.alias("description"))
    allc = codes.select("code", "label", "description").unionByName(missing)
    lab = allc.select(F.col("code").alias("transaction_code"), F.col("label").alias("code_label"),
                      F.col("description").alias("code_description"))
    return ledger.join(lab, "transaction_code", "left")


def seed_codes(codes_existing: DataFrame, spark) -> DataFrame:
    from ..sources.sinks import seed
    return seed(codes_existing, schemas.transaction_code_df(spark), ["code"])


def filing_rollup(ledger: DataFrame, codes: DataFrame) -> DataFrame:
    """A10: per filing: net shares (acquired - disposed), net value, remaining
    shares (holding of the last line that has one) and primary activity (the
    code label, 'Mixed' when several codes)."""
    ad = F.col("acquired_disposed")
    sign = F.when(ad == "A", F.lit(1)).when(ad == "D", F.lit(-1)).otherwise(F.lit(0))
    value = (F.col("shares") * F.col("price_per_share")).cast("decimal(38,4)")
    agg = ledger.groupBy("insider_filing_id").agg(
        F.sum(F.col("shares") * sign).cast("decimal(20,4)").alias("net_change"),
        F.sum(value * sign).cast("decimal(20,2)").alias("net_value"),
        F.max_by("shares_owned_following",
                 F.when(F.col("shares_owned_following").isNotNull(), F.col("line_number"))).alias("remaining_shares"),
        F.count_distinct("transaction_code").alias("_ncodes"),
        F.min("transaction_code").alias("_code"),
    )
    lab = codes.select(F.col("code").alias("_code"), F.col("label"))
    j = agg.join(lab, "_code", "left")
    return j.select(
        "insider_filing_id", "net_change", "net_value", "remaining_shares",
        F.when(F.col("_ncodes") > 1, F.lit("Mixed"))
        .when(F.col("_ncodes") == 1, F.coalesce(F.col("label"), F.concat(F.lit("Other ("), F.col("_code"), F.lit(")"))))
        .alias("primary_activity"),
    )


def insider_cursor(filing: DataFrame) -> DataFrame:
    """Latest completed insider filing per ticker (date DESC, id DESC)."""
    done = filing.where(F.col("completed"))
    return latest_by(done, ["ticker_id"], [F.col("filing_date"), F.col("id")],
                     ["accession_no", "filing_date"]).select(
        "ticker_id", F.col("accession_no").alias("latest_completed_accession"),
        F.col("filing_date").alias("latest_completed_filing_date"))


def filing_cursor(filing: DataFrame, forms=("8-K", "10-K")) -> DataFrame:
    """Latest completed filing per ticker among ``forms`` (date DESC, id DESC)."""
    done = filing.where(F.col("completed") & F.col("type").isin(*forms))
    return latest_by(done, ["tickerId"], [F.col("filingDate"), F.col("id")],
                     ["accessionNo", "filingDate"]).select(
        "tickerId", F.col("accessionNo").alias("latest_completed_accession"),
        F.col("filingDate").alias("latest_completed_filing_date"))
