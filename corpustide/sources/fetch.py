"""Download of items: one paced stream of requests, resumable by a journal, every outcome named."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import values as V
from ..operators.extract import slug
from .register import Refused, fetch_page, record_archive, transport

#: What may be asked again.
AGAIN = (409, 429, 500, 502, 503, 504)


class Malformed(ValueError):
    """A page declares an array of documents that cannot be read: a pack without them would look whole."""


def retried(
    call: Callable[[], tuple[int, dict[str, str], bytes]], tries: int = 5, wait: float = 1.0, sleep: Callable = time.sleep
) -> tuple[int, dict[str, str], bytes]:
    """An answer (status, headers, body) worth having: busy ones are asked again, after what they ask for, a minute at most."""
    for n in range(tries):
        answer = call()
        if answer[0] not in AGAIN or n + 1 == tries:
            return answer
        asked = answer[1].get("Retry-After", "")
        sleep(min(60.0, float(asked)) if asked.isdigit() else wait * 2**n)
    raise AssertionError("unreachable")


def read_json(call: Callable[[], tuple[int, dict[str, str], bytes]], **how) -> object | None:
    """A stored JSON document; None where it is absent or cannot be read; other refusals are errors."""
    status, _, body = retried(call, **how)
    if status == 404:
        return None
    if status >= 400:
        raise RuntimeError(f"status {status}")
    try:
        return json.loads(body)
    except ValueError:
        return None


def upload(
    data: bytes, put: Callable[[tuple[int, int], bytes], int], tries: int = 5, single: int = 4 << 20, chunk: int = 10 << 20,
    sleep: Callable = time.sleep
) -> int:
    """Bytes put as one, or as ranges in order; each is tried again while the store is busy. Gives the number of requests that were needed."""
    from .publish import ranges

    asked = 0
    for a, b in ranges(len(data), single, chunk):
        for n in range(tries):
            asked += 1
            status = put((a, b), data[a:b])
            if status < 400:
                break
            if status not in AGAIN or n + 1 == tries:
                raise RuntimeError(f"status {status} for bytes {a} to {b}")
            sleep(2.0**n)
    return asked


def pause_for(received: int, cap: float = V.PAUSE_CAP, floor: float = V.PAUSE_FLOOR, per_mib: float = V.PAUSE_PER_MIB) -> float:
    return max(min(floor, cap), min(cap, floor + received / 1048576 * per_mib)) if cap > 0 else 0.0


def script_array(page: str, name: str) -> list[dict]:
    """The array assigned to ``name``, empty where the page has none; an unreadable one is an error."""
    at = re.search(rf"\b{re.escape(name)}\s*=\s*", page)
    if at is None:
        return []
    try:
        value, _ = json.JSONDecoder().raw_decode(page, at.end())
    except ValueError as e:
        raise Malformed(f"{name}: {e}") from e
    return value if isinstance(value, list) else []


def page_records(page: str, sections: tuple[str, ...] = ("actual", "archive")) -> list[dict]:
    """Records of a page by section, each with what a request for it needs; ``downloadable`` unless its icon is off."""
    out = []
    for section, name in (("actual", V.CURRENT_ARRAY), ("archive", V.ARCHIVE_ARRAY)):
        for r in script_array(page, name) if section in sections else ():
            title = r.get("Title") or (r.get("DocumentTitle") or {}).get("Title") or ""
            out.append({
                "section": section, "id": str(r.get("Id")), "title": title.strip(), "type_code": r.get("TypeCode"),
                "publish_date": r.get("PublishDate"), "link_type": r.get("DocumentLinkTypeCode") or V.DEFAULT_LINK_TYPE,
                "downloadable": r.get("ShowDownloadIcon") is not False
            })
    return out


def stored_files(files: list[tuple[str, bytes]], section: str, seen: dict[tuple[str, str], str], taken: set[str]) -> Iterator[dict]:
    """Rows of a record's files: bytes and name met before are a duplicate at the first one's path; a taken name gets ten digits of the digest."""
    for name, data in files:
        digest, clean = hashlib.sha256(data).hexdigest(), slug(name.replace("\\", "/").rsplit("/", 1)[-1])
        path = seen.get((clean, digest))
        duplicate = path is not None
        if path is None:
            path = f"{section}/{clean}"
            if path in taken:
                stem, dot, ext = path.rpartition(".")
                path = f"{stem}-{digest[:10]}{dot}{ext}" if dot else f"{path}-{digest[:10]}"
            seen[clean, digest] = path
            taken.add(path)
        yield {
            "filename": clean, "original_name": name, "path": path, "size": len(data), "sha256": digest, "duplicate": duplicate,
            "content": None if duplicate else data
        }


SCHEMA = (
    "target string, pid string, outcome string, error string, html string, record_id string, section string, title string, type_code string, publish_date string, link_type string, withheld boolean, method string, "
    "filename string, original_name string, path string, size long, sha256 string, duplicate boolean, content binary"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


#: Rows and bytes of files that are gathered before a task hands them on.
GATHERED, GATHERED_BYTES = 2000, 16 << 20


def fetch(targets: DataFrame, by: str, pause: float = V.PAUSE_CAP, sections: tuple[str, ...] = ("actual", "archive"), streams: int = 1) -> DataFrame:
    """Rows of each target (target, pid, url, done: ids of records that the journal has): one with its outcome and page, one a withheld record, one a file.

    ``by`` names a transport, ``module:function``, that gives an object with ``page(url)``, ``archive(pid, record)``,
    ``list(pid, record)`` and ``file(pid, record, entry)``. One target that fails does not end the run: its outcome is
    failed, or withdrawn where the platform refuses it for good. The platform asks for a single stream, which is one
    task; a store that allows more is asked in ``streams`` tasks, each of which waits as many times as long, so that
    together they ask no faster.
    """

    def one(row, client) -> Iterator[dict]:
        base = {"target": row.target, "pid": row.pid}
        page = fetch_page(client.page, row.url, sleep=time.sleep if pause else lambda s: None)
        records = page_records(page, sections)
        seen: dict[tuple[str, str], str] = {}
        taken: set[str] = set()
        done = set(row.done if row.done is not None else ())
        out = []
        for r in records:
            about = base | {"record_id": r["id"], **{k: r[k] for k in ("section", "title", "type_code", "publish_date", "link_type")}}
            if not r["downloadable"]:
                out.append(about | {"outcome": "record", "withheld": True})
                continue
            if r["id"] in done:
                continue
            method, files = _files(client, row.pid, r)
            rows = list(stored_files(files, r["section"], seen, taken))
            out += [about | f | {"outcome": "file", "withheld": False, "method": method} for f in rows]
            if pause:
                time.sleep(streams * pause_for(sum(f["size"] for f in rows), pause))
        yield base | {"outcome": "done", "html": page}
        yield from out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = transport(by)()
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples():
                try:
                    rows = list(one(row, client))
                except Refused as e:
                    rows = [{"target": row.target, "pid": row.pid, "outcome": "withdrawn", "error": str(e)[:200]}]
                except Exception as e:  # one bad target never ends the run
                    rows = [{"target": row.target, "pid": row.pid, "outcome": "failed", "error": str(e)[:200]}]
                out += rows
                held += sum(len(r.get("content") or b"") + len(r.get("html") or "") for r in rows)
                if len(out) >= GATHERED or held >= GATHERED_BYTES:
                    yield _frame(out)
                    out, held = [], 0
            if out:
                yield _frame(out)

    rows = targets.select("target", "pid", "url", "done")
    return (rows.coalesce(1) if streams == 1 else rows.repartition(streams, "target")).mapInPandas(run, SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in COLUMNS})


def notice_pages(notices: DataFrame, by: str, pause: float = 0.25) -> DataFrame:
    """(uuid, html): each notice's own page, from which its platform page follows; null where it cannot be read. ``by``: see :func:`fetch`.

    One task, as the register asks for a single stream.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = transport(by)()
        for batch in batches:
            found = []
            for link in batch["link"]:
                try:
                    found.append(client.page(link))
                except Exception:  # a notice without its page stays, without a link
                    found.append(None)
                time.sleep(pause)
            yield pd.DataFrame({"uuid": batch["uuid"], "html": pd.Series(found, dtype=object)})

    return notices.select("uuid", "link").coalesce(1).mapInPandas(run, "uuid string, html string")


def _files(client, pid: str, record: dict) -> tuple[str, list[tuple[str, bytes]]]:
    """(method, files) of a record: the members of its archive, or where there is none each file on its own."""
    members = record_archive(lambda _: client.archive(pid, record), "")
    if members is not None:
        return "zip", members
    return "files", [(f["name"], client.file(pid, record, f)) for f in client.list(pid, record)]
