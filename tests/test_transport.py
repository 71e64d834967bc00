"""HttpTransport glue without a network: the session's ``get`` is replaced by canned responses."""

import json

import pytest

from strata.sources import transport as TR
from strata.sources.staging import load_staged_json


class FakeResponse:
    def __init__(self, status, body, links=None):
        self.status_code = status
        self.text = body if isinstance(body, str) else json.dumps(body)
        self.links = links or {}

    def json(self):
        return json.loads(self.text)

    def raise_for_status(self):
        import requests

        if self.status_code >= 400:
            raise requests.exceptions.HTTPError(str(self.status_code))


@pytest.fixture()
def http(monkeypatch):
    import requests

    calls = []
    answers = {}

    def get(self, url, params=None, timeout=None):
        calls.append((url, dict(params or {})))
        a = answers[url] if url in answers else answers.get((url, tuple(sorted((params or {}).items()))))
        if isinstance(a, Exception):
            raise a
        return a

    monkeypatch.setattr(requests.Session, "get", get)
    return answers, calls


def test_detail_fetch_and_network_error(http):
    answers, calls = http
    answers["https://api.example/objects/7"] = FakeResponse(200, {"objectID": 7})
    import requests

    answers["https://api.example/objects/8"] = requests.exceptions.ConnectionError("reset")
    t = TR.HttpTransport("https://api.example/objects/{id}", headers={"Authorization": "Bearer x"}).open()
    assert t.fetch(7) == (200, '{"objectID": 7}')
    with pytest.raises(TR.TransportError):
        t.fetch(8)
    assert t._session.headers["Authorization"] == "Bearer x"


def test_cursor_list_pages(http):
    answers, calls = http
    base = "https://api.example/v1/customers"
    answers[(base, (("limit", 2),))] = FakeResponse(200, {"data": [{"id": "a"}, {"id": "b"}], "has_more": True})
    answers[(base, (("limit", 2), ("starting_after", "b")))] = FakeResponse(200, {"data": [{"id": "c"}],
                                                                                 "has_more": False})
    t = TR.HttpTransport(base + "/{id}", list_url=base).open()
    assert t.list_page("stripe", None, 2) == (["a", "b"], True)
    assert t.list_page("stripe", "b", 2) == (["c"], False)


def test_link_pages(http):
    answers, calls = http
    first = "https://api.example/repos"
    answers[(first, (("limit", 2),))] = FakeResponse(200, [{"id": 1}, {"id": 2}],
                                                    links={"next": {"url": first + "?page=2"}})
    answers[first + "?page=2"] = FakeResponse(200, [{"id": 3}])
    t = TR.HttpTransport(first + "/{id}", list_url=first).open()
    ids, nxt = t.link_page("gh", None, 2)
    assert ids == [1, 2] and nxt == first + "?page=2"
    assert t.link_page("gh", nxt, 2) == ([3], None)


def test_one_shot_list_body():
    assert TR.extract_ids({"total": 2, "objectIDs": [1, 2]}, "objectIDs") == [1, 2]
    assert TR.extract_ids({"total": 0, "objectIDs": None}, "objectIDs") == []
    assert TR.extract_ids({"data": [{"id": "x"}]}, "data[].id") == ["x"]


def test_staged_json_layout(spark, tmp_path):
    for k in (3, 11):
        (tmp_path / f"{k}.json").write_text(json.dumps({"objectID": k}))
    rows = sorted(tuple(r) for r in load_staged_json(spark, str(tmp_path)).collect())
    assert rows == [(3, 200, '{"objectID": 3}', None), (11, 200, '{"objectID": 11}', None)]


def test_headers_are_made_by_the_task_and_renewed_on_401(http, monkeypatch):
    import requests

    made, seen = [], []

    def headers():
        made.append(1)
        return {"Authorization": f"Bearer {len(made)}"}

    def get(self, url, params=None, timeout=None):
        seen.append(self.headers["Authorization"])
        return FakeResponse(401 if seen[-1] == "Bearer 1" else 200, {"id": 1})

    monkeypatch.setattr(requests.Session, "get", get)
    t = TR.HttpTransport("https://api.example/{id}", headers=headers)
    assert not made                                # nothing on the driver
    assert t.open().fetch(1)[0] == 200 and seen == ["Bearer 1", "Bearer 2"]


def test_root_arrays_of_list_pages(http):
    answers, _ = http
    answers["https://api.example/list"] = FakeResponse(200, [{"id": 1}, {"id": 2}])
    t = TR.HttpTransport("u", "https://api.example/list").open()
    assert t.list_page("a", None, 2) == ([1, 2], True) and t.list_page("a", None, 3) == ([1, 2], False)
