"""HTTP transport for `remote.Client`: the public web API of a knowledge base and its query service, with the standard library."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from http.cookiejar import CookieJar
from urllib.parse import urlencode

from ..config import Config, Credentials
from .remote import RetryableError, retryable


class Transport:
    def __init__(self, credentials: Credentials, config: Config):
        self.credentials, self.config = credentials, config
        self.opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor(CookieJar()))
        self.token = ""

    def __call__(self, kind: str, payload: dict):
        return getattr(self, "_" + kind)(**payload)

    def _post(self, url: str, accept: str = "application/json", **fields) -> dict:
        request = urllib.request.Request(url, urlencode(fields).encode(), {"Accept": accept, "User-Agent": f"kgsync/{self.config.pipeline_version}"})
        try:
            with self.opener.open(request, timeout=self.config.request_timeout_seconds) as answer:
                out = json.load(answer)
        except urllib.error.HTTPError as e:
            raise (RetryableError if retryable(e.code) else RuntimeError)(f"status {e.code}") from e
        except urllib.error.URLError as e:
            raise RetryableError(str(e.reason)) from e
        if "error" in out:
            raise RuntimeError(out["error"].get("info", str(out["error"])))
        return out

    def _api(self, **fields) -> dict:
        return self._post(self.credentials.api_url, format="json", **fields)

    # ---- probes

    def _probe_api(self) -> bool:
        return "query" in self._api(action="query", meta="siteinfo")

    def _probe_authenticated(self) -> bool:
        token = self._api(action="query", meta="tokens", type="login")["query"]["tokens"]["logintoken"]
        return self._api(action="login", lgname=self.credentials.username, lgpassword=self.credentials.password, lgtoken=token)["login"]["result"] == "Success"

    def _probe_sparql(self) -> bool:
        return self._sparql("SELECT * WHERE { ?s ?p ?o } LIMIT 1") is not None

    # ---- reads

    def _sparql(self, query: str) -> list[dict]:
        return self._post(self.credentials.sparql_url, "application/sparql-results+json", query=query, format="json")["results"]["bindings"]

    def _item(self, qid: str) -> dict:
        found = self._api(action="wbgetentities", ids=qid)["entities"][qid]
        if "missing" in found:
            raise RuntimeError(f"{qid} is missing")
        one = lambda part: {k: v["value"] for k, v in (found.get(part) or {}).items()}
        claims = {p: [json.dumps(c["mainsnak"]["datavalue"]) for c in cs if "datavalue" in c.get("mainsnak", {})] for p, cs in (found.get("claims") or {}).items()}
        return {"labels": one("labels"), "descriptions": one("descriptions"), "aliases": {k: [a["value"] for a in v] for k, v in (found.get("aliases") or {}).items()}, "claims": claims}

    # ---- writes

    def _write(self, **fields) -> dict:
        if not self.token:
            self.token = self._api(action="query", meta="tokens")["query"]["tokens"]["csrftoken"]
        return self._api(token=self.token, bot="1", **fields)

    @staticmethod
    def _terms(labels: dict, descriptions: dict, aliases: dict) -> str:
        one = lambda values: {k: {"language": k, "value": v} for k, v in values.items()}
        added = [{"language": k, "value": v, "add": ""} for k, vs in aliases.items() for v in vs]
        return json.dumps({"labels": one(labels), "descriptions": one(descriptions), "aliases": added}, ensure_ascii=False)

    def _create(self, labels: dict, descriptions: dict, aliases: dict) -> str:
        return self._write(action="wbeditentity", new="item", data=self._terms(labels, descriptions, aliases))["entity"]["id"]

    def _metadata(self, qid: str, labels: dict, descriptions: dict, aliases: dict) -> None:
        self._write(action="wbeditentity", id=qid, data=self._terms(labels, descriptions, aliases))

    def _claim(self, qid: str, pid: str, datatype: str, datavalue: str) -> None:
        """A claim's value is that of its datavalue, whatever the datatype."""
        self._write(action="wbcreateclaim", entity=qid, property=pid, snaktype="value", value=json.dumps(json.loads(datavalue)["value"], ensure_ascii=False))
