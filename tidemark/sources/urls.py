"""Addresses of the paged listings: as columns, and as text for readers that have no columns."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import encode_ref


def _with(base: Column, **parts: Column | None) -> Column:
    out = base
    for name, value in parts.items():
        if value is not None:
            out = F.concat(out, F.lit(f"&{name}="), value.cast("string"))
    return out


def archive_url(api: str, ref: Column) -> Column:
    return F.concat(F.lit(api.rstrip("/") + "/"), encode_ref(ref))


def listing_url(api: str, ref: Column, start: int = 0, size: int = 300, status: str | None = None) -> Column:
    """A page of all published entries of an archive, in no order."""
    base = F.concat(archive_url(api, ref), F.lit("?ws.op=getPublishedBinaries&ordered=false"))
    return _with(base, **{"ws.size": F.lit(size), "ws.start": F.lit(start), "status": F.lit(status) if status else None})


def name_url(api: str, ref: Column, name: Column, size: int = 300) -> Column:
    """The entries of exactly one name."""
    base = F.concat(archive_url(api, ref), F.lit("?ws.op=getPublishedBinaries&ordered=false&exact_match=true"))
    return _with(base, **{"ws.size": F.lit(size), "binary_name": encode_ref(name)})


def counts_url(api: str, ref: Column, source_id: Column, since: Column | None = None, size: int = 300) -> Column:
    """The daily counts of a release, from a first day on if one is given and not null."""
    base = F.concat(archive_url(api, ref), F.lit("/+binarypub/"), source_id.cast("string"), F.lit("?ws.op=getDownloadCounts"))
    url = _with(base, **{"ws.size": F.lit(size)})
    if since is None:
        return url
    return F.concat(url, F.coalesce(F.concat(F.lit("&start_date="), F.date_format(since, "yyyy-MM-dd")), F.lit("")))


def listing_address(api: str, ref: str, status: str | None = None, name: str | None = None, size: int = 300) -> str:
    """``listing_url`` from the first entry on, or ``name_url`` where a name is given."""
    if name is None:
        out = f"{api.rstrip('/')}/{quote(ref, safe='')}?ws.op=getPublishedBinaries&ordered=false&ws.size={size}&ws.start=0"
    else:
        out = f"{api.rstrip('/')}/{quote(ref, safe='')}?ws.op=getPublishedBinaries&ordered=false&exact_match=true&ws.size={size}&binary_name={quote(name, safe='')}"
    return out + (f"&status={quote(status, safe='')}" if status else "")


def counts_address(api: str, ref: str, source_id: int, since: str | None = None, size: int = 300) -> str:
    """``counts_url`` of one release."""
    return f"{api.rstrip('/')}/{quote(ref, safe='')}/+binarypub/{source_id}?ws.op=getDownloadCounts&ws.size={size}" + (f"&start_date={since}" if since else "")
