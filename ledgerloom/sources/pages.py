"""Records out of landed JSON pages.

Pages land as rows ``(endpoint, page_no, status, body)``, however they were
fetched. The rules of a paged read decide which of them count: a read goes
through an endpoint's pages in order and stops at the first that ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table

NO_LIMIT = 2**62
# Bodies and values of any length are read.
UNBOUNDED = {"maxStringLen": str(2**31 - 1), "maxNestingDepth": "10000"}
CORRUPT = "__corrupt"


def _opens_with(body: Column, mark: str) -> Column:
    return F.ltrim(F.substr(body, F.lit(1), F.lit(1024))).startswith(mark)


def _page(body: Column, results_key: str | None, next_page_url_key: str | None) -> Column:
    """What a read looks at in a body, as a struct: ``records``, each as JSON text, and ``following``.

    ``records`` is null where the body has no list that can be read.
    """
    names = [results_key] if results_key else []
    if next_page_url_key and next_page_url_key not in names:
        names.append(next_page_url_key)
    fields = [T.StructField(n, T.ArrayType(T.StringType()) if n == results_key else T.StringType()) for n in names]
    read = F.from_json(body, T.StructType(fields), UNBOUNDED) if fields else None
    following = read[next_page_url_key] if next_page_url_key and next_page_url_key != results_key else F.lit(None).cast("string")
    top = F.when(_opens_with(body, "["), F.from_json(body, T.ArrayType(T.StringType()), UNBOUNDED))
    return F.struct((read[results_key] if results_key else top).alias("records"), following.alias("following"))


def _is_object(body: Column) -> Column:
    """Whether a body is one object. Its values are passed over, not kept."""
    read = F.from_json(body, f"{CORRUPT} string", {**UNBOUNDED, "columnNameOfCorruptRecord": CORRUPT})
    return F.coalesce(_opens_with(body, "{") & read[CORRUPT].isNull(), F.lit(False))


def _record(text: Column, schema: T.StructType) -> Column:
    """A record by the declared schema; the last value of a repeated key counts.

    Plain values are read as text and then cast, so that quoted numbers and
    dates convert; what does not convert is null.
    """
    plain = [not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) for f in schema]
    loose = T.StructType([T.StructField(f.name, T.StringType() if p else f.dataType) for f, p in zip(schema, plain)])
    read = F.from_json(text, loose, UNBOUNDED)

    def typed(field: T.StructField) -> Column:
        text = read[field.name]
        value = text.try_cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType):
            # Whole numbers may be written with a point.
            value = F.coalesce(value, text.try_cast("decimal(38,6)").try_cast(field.dataType))
        return value

    return F.struct(*[(typed(f) if p else read[f.name]).alias(f.name) for f, p in zip(schema, plain)])


def _struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    found = T.StructType.fromDDL(schema)
    # A text like struct<..> is read as one column of that type.
    if schema.lower().startswith("struct<") and len(found) == 1 and isinstance(found[0].dataType, T.StructType):
        return found[0].dataType
    return found


def last_attempts(pages: DataFrame) -> DataFrame:
    """Of a page that landed several times the last attempt, where a column ``attempt`` tells them apart.

    A null attempt comes before all others: it counts where there is no other.
    """
    if "attempt" not in pages.columns:
        return pages
    last = pages.groupBy("endpoint", "page_no").agg(F.max("attempt").alias("__last"), F.count("attempt").alias("__n"))
    found = lookup_join(pages, written_table(last, "last-attempts"), ["endpoint", "page_no"], "inner")
    return found.where((F.col("__n") == 0) | (F.col("attempt") == F.col("__last"))).drop("__last", "__n")


def _page_ends(
    pages: DataFrame, results_key: str | None, next_page_url_key: str | None, paged: bool
) -> DataFrame:
    """Per page: does the read stop before it (its records do not count) or after it?"""
    records = F.col("__page.records")
    lone_object = F.lit(False) if results_key else F.col("__object")
    usable = (F.col("status") == 200) & ((records.isNotNull() & (F.size(records) > 0)) | lone_object)
    if not paged:
        ends_after = F.lit(True)
    elif next_page_url_key:
        ends_after = lone_object | F.coalesce(F.col("__page.following") == "", F.lit(True))
    else:
        ends_after = lone_object
    read = pages.select(
        "endpoint",
        "page_no",
        "status",
        _page(F.col("body"), results_key, next_page_url_key).alias("__page"),
        (F.lit(False) if results_key else _is_object(F.col("body"))).alias("__object"),
    )
    return read.select(
        "endpoint",
        "page_no",
        F.when(~F.coalesce(usable, F.lit(False)), F.col("page_no") - 1)
        .when(ends_after, F.col("page_no"))
        .alias("last_page"),
    )


def last_pages(
    pages: DataFrame,
    results_key: str | None = None,
    next_page_url_key: str | None = None,
    paged: bool = True,
    max_pages: int | None = None,
    first_page: int = 1,
) -> DataFrame:
    """Last page that counts, for each endpoint.

    A page number that never landed ends the read like a failed one. The
    smallest end wins; it is found by partial aggregation, so an endpoint with
    very many pages needs no task of its own. Where a page landed several times,
    the row that lets the read go furthest counts.
    """
    ends = _page_ends(pages, results_key, next_page_url_key, paged)
    limit = NO_LIMIT if max_pages is None else first_page + max_pages - 1
    landed = ends.select(
        "endpoint",
        F.inline(
            F.array(
                F.struct(F.col("page_no").alias("page_no"), F.lit(1).alias("landed"), F.col("last_page")),
                F.struct((F.col("page_no") + 1).alias("page_no"), F.lit(0).alias("landed"), F.lit(None).cast("long").alias("last_page")),
            )
        ).alias("page_no", "landed", "last_page"),
    ).where(F.col("page_no") >= first_page)
    by_page = landed.groupBy("endpoint", "page_no").agg(
        F.max("landed").alias("landed"),
        F.min("landed").alias("follows"),
        F.bool_or((F.col("landed") == 1) & F.col("last_page").isNull()).alias("goes_on"),
        F.max("last_page").alias("last_page"),
    )
    unreached = (F.col("follows") == 1) & (F.col("page_no") > first_page)
    end = F.when(unreached | (F.col("landed") == 0), F.col("page_no") - 1).when(~F.col("goes_on"), F.col("last_page"))
    started = F.max(F.when((F.col("page_no") == first_page) & (F.col("landed") == 1), 1))
    return by_page.groupBy("endpoint").agg(
        F.when(started.isNotNull(), F.least(F.min(end), F.lit(limit)))
        .otherwise(F.lit(first_page - 1))
        .alias("last_page")
    )


def fetch_all(
    pages: DataFrame,
    record_schema: T.StructType | str,
    results_key: str | None = None,
    next_page_url_key: str | None = None,
    paged: bool = True,
    max_pages: int | None = None,
    first_page: int = 1,
) -> DataFrame:
    """All records a paged read of each endpoint returns, with their place.

    Records lie in the list under ``results_key``, else in a top-level list;
    else the object itself is one record and ends the read. A page with a bad
    status, a body that does not decode, no list or an empty list ends the read
    before its own records; an absent or null ``next_page_url_key`` and the page
    limit end it after them. ``max_pages`` of None means no limit, and
    ``paged=False`` reads the first page only. Bodies and values may be of any
    size; of a key repeated within an object the last value counts. With a
    column ``attempt`` the last attempt of a page counts.

    While the table of last pages is small enough to broadcast, bodies do not
    cross the network: the pass that finds it shuffles page numbers only. With
    more endpoints than that, the pages that count are shuffled once.
    """
    schema = _struct(record_schema)
    pages = last_attempts(pages)
    ends = written_table(
        last_pages(pages, results_key, next_page_url_key, paged, max_pages, first_page), "last-pages"
    )
    counted = lookup_join(
        pages.where((F.col("status") == 200) & (F.col("page_no") >= first_page)), ends, ["endpoint"], "inner"
    ).where(F.col("page_no") <= F.col("last_page"))
    records = _page(F.col("body"), results_key, None)["records"]
    if not results_key:
        records = F.coalesce(records, F.when(_is_object(F.col("body")), F.array(F.col("body"))))
    return (
        counted.select("endpoint", "page_no", F.posexplode(records).alias("record_no", "__text"))
        .withColumn("__record", _record(F.col("__text"), schema))
        .select("endpoint", "page_no", "record_no", "__record.*")
    )


def fetch_configured(
    pages: DataFrame, record_schema: T.StructType | str, pagination: dict, results_key: str | None = None
) -> DataFrame:
    """``fetch_all`` by a ``pagination`` section: page numbers, offsets or next-page keys.

    With offsets, ``page_no`` holds the offset of each page's first record. A
    page limit of 0 means no limit here.
    """
    kind = pagination.get("type", "page_number")
    if kind not in ("page_number", "offset_limit", "next_url"):
        raise ValueError(f"unknown pagination type {kind!r}")
    if kind == "offset_limit":
        size = F.lit(pagination["page_size"])
        pages = pages.withColumn("page_no", F.call_function("div", F.col("page_no"), size) + 1)
    return fetch_all(
        pages,
        record_schema,
        results_key,
        pagination.get("next_url_key", "next") if kind == "next_url" else None,
        max_pages=pagination.get("max_pages") or None,
    )


def single_records(pages: DataFrame, record_schema: T.StructType | str) -> DataFrame:
    """One record per page with status 200 and an object for a body; other pages give none."""
    keys = [c for c in pages.columns if c not in ("status", "body")]
    return (
        pages.where(F.col("status") == 200)
        .where(_is_object(F.col("body")))
        .select(*keys, _record(F.col("body"), _struct(record_schema)).alias("__record"))
        .select(*keys, "__record.*")
    )
