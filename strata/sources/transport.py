"""Transports: how one task talks to a remote API.

A transport is a small picklable object shipped to executors. Each task calls
``open()`` once (one HTTP session per partition), then ``fetch`` per id and
``list_page`` per page. Network failures must surface as ``TransportError``;
anything else is a bug and fails the task.
"""

from __future__ import annotations

import json
from typing import Any, Callable, Sequence


class TransportError(Exception):
    """A request that did not produce an HTTP status (timeout, reset, DNS...)."""


class Transport:
    # Columns of the id rows this transport needs next to the key (replay data,
    # per-source config ...). They are carried through the fetch shuffle. For a
    # page walk each call gets a row of its chain, in the order of the column
    # ``order``, as a last argument.
    carry: Sequence[str] = ()
    order: str | None = None

    def open(self) -> "Transport":
        return self

    def close(self) -> None:
        pass

    def fetch(self, key: Any, row: dict | None = None) -> tuple[int, str | None]:
        raise NotImplementedError

    def list_page(self, source: Any, cursor: Any, page_size: int) -> tuple[list, bool]:
        raise NotImplementedError

    def link_page(self, source: Any, link: str | None, page_size: int) -> tuple[list, str | None]:
        raise NotImplementedError


class HttpTransport(Transport):
    """GET ``detail_url`` with ``{id}`` filled in; list endpoints with a cursor param.

    ``headers`` is a dict or a function that returns one. A function is called by
    each task when it opens its session and again when an answer is 401, so a
    token that expires during a long pull is fetched anew.
    """

    def __init__(self, detail_url: str, list_url: str | None = None, headers: dict | Callable[[], dict] | None = None,
                 timeout: float = 30.0, cursor_param: str = "starting_after",
                 limit_param: str = "limit", ids_path: str = "data[].id",
                 more_field: str = "has_more"):
        self.detail_url = detail_url
        self.list_url = list_url
        self.headers = headers if callable(headers) else dict(headers or {})
        self.timeout = timeout
        self.cursor_param = cursor_param
        self.limit_param = limit_param
        self.ids_path = ids_path
        self.more_field = more_field
        self._session = None

    def open(self):
        import requests  # imported on the executor only

        t = HttpTransport.__new__(HttpTransport)
        t.__dict__.update(self.__dict__)
        t._session = requests.Session()
        t._authorize()
        return t

    def _authorize(self):
        self._session.headers.update(self.headers() if callable(self.headers) else self.headers)

    def _get(self, url, params=None):
        import requests

        try:
            r = self._session.get(url, params=params, timeout=self.timeout)
            if r.status_code == 401 and callable(self.headers):
                self._authorize()
                r = self._session.get(url, params=params, timeout=self.timeout)
        except requests.exceptions.RequestException as exc:
            raise TransportError(str(exc)) from exc
        return r

    def _get_page(self, url, params=None):
        import requests

        r = self._get(url, params)
        try:
            r.raise_for_status()
        except requests.exceptions.RequestException as exc:
            raise TransportError(str(exc)) from exc
        return r

    def close(self):
        if self._session is not None:
            self._session.close()

    def fetch(self, key, row=None):
        r = self._get(self.detail_url.format(id=key))
        return r.status_code, r.text

    def link_page(self, source, link, page_size):
        """GET the first page (or ``link``); the next page is the ``rel="next"`` Link header."""
        url = link or (source if isinstance(source, str) and source.startswith("http") else self.list_url)
        r = self._get_page(url, None if link else {self.limit_param: page_size})
        return extract_ids(r.json(), self.ids_path), (r.links.get("next") or {}).get("url")

    def list_page(self, source, cursor, page_size):
        params = {self.limit_param: page_size}
        if cursor is not None:
            params[self.cursor_param] = cursor
        url = source if isinstance(source, str) and source.startswith("http") else self.list_url
        body = self._get_page(url, params).json()
        ids = extract_ids(body, self.ids_path)
        # an array at the root has no flag: a full page may have a successor
        return ids, len(ids) >= page_size if isinstance(body, list) else bool(body.get(self.more_field))


def extract_ids(body, path: str) -> list:
    """``objectIDs`` -> body["objectIDs"]; ``data[].id`` -> [d["id"] for d in body["data"]]; a root array as it is."""
    if isinstance(body, list):
        field = path.rpartition("[].")[2] if "[]." in path else "id"
        return [d.get(field) if isinstance(d, dict) else d for d in body]
    if "[]." in path:
        arr, field = path.split("[].", 1)
        return [d.get(field) for d in (body.get(arr) or [])]
    return list(body.get(path) or [])


class ReplayTransport(Transport):
    """Answers from columns carried with each id row (no network).

    ``status_col`` holds the status every attempt returns, ``body_col`` the
    body text. A status of 0 stands for a network failure.
    """

    def __init__(self, status_col: str = "replay_status", body_col: str = "replay_body"):
        self.status_col = status_col
        self.body_col = body_col
        self.carry = (status_col, body_col)

    def fetch(self, key, row=None):
        status = int(row[self.status_col])
        if status == 0:
            raise TransportError("replayed network failure")
        return status, row[self.body_col]


class ReplayPages(Transport):
    """A list API answered from rows that Spark made, one per page: its place, the cursor that asks for it, ids, more.

    A walk that asks with another cursor than the last page's fails, so the walk
    itself is put to the test.
    """

    carry = ("replay_page", "replay_cursor", "replay_ids", "replay_more")
    order = "replay_page"

    def list_page(self, source, cursor, page_size, row=None):
        if row is None:
            return [], False
        asked, held = (None if x is None else str(x) for x in (cursor, row["replay_cursor"]))
        ids = list(row["replay_ids"])
        if asked != held or len(ids) > page_size:
            raise ValueError(f"page {row['replay_page']} of {source} follows {held}, not {asked}")
        return ids, bool(row["replay_more"])

    def link_page(self, source, link, page_size, row=None):
        ids, more = self.list_page(source, None if link is None else link.rsplit("after=", 1)[1], page_size, row)
        return ids, f"replay:{source}?limit={page_size}&after={ids[-1]}" if more else None

    def offset_page(self, source, offset, limit, row=None):
        return [] if row is None or row["replay_ids"] is None else list(row["replay_ids"])


class ScriptedTransport(Transport):
    """Per-key scripted answers for tests: {key: [503, 503, (200, body)]}.

    Each attempt consumes the next answer; the last one repeats. The string
    ``"raise"`` simulates a network exception.
    """

    def __init__(self, script: dict, default=(200, "{}"), pages: dict | None = None):
        self.script = script
        self.default = default
        self.pages = pages or {}
        self._seen: dict = {}
        self.calls: list = []

    def open(self):
        self._seen = {}
        return self

    def fetch(self, key, row=None):
        answers = self.script.get(key, [self.default])
        i = self._seen.get(key, 0)
        self._seen[key] = i + 1
        a = answers[min(i, len(answers) - 1)]
        self.calls.append(key)
        if a == "raise":
            raise TransportError("connection reset")
        if isinstance(a, tuple):
            return a
        return int(a), (json.dumps({"id": key}) if int(a) == 200 else None)

    def list_page(self, source, cursor, page_size):
        """``pages[source]`` is the sorted id list the remote side holds."""
        ids = self.pages.get(source, [])
        start = 0 if cursor is None else next((i + 1 for i, v in enumerate(ids) if v == cursor), len(ids))
        page = ids[start:start + page_size]
        return page, start + page_size < len(ids)
