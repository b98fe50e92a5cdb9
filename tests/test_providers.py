"""Providers by name, with clients that stand in for the services."""

import json
from http.server import BaseHTTPRequestHandler, HTTPServer
from threading import Thread
from types import SimpleNamespace as Has

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import embedding, providers, requirements

ANSWER = json.dumps({"requirements": [{"req_name": "n", "req_type": "기능"}]})


def openai_client():
    def create(model, temperature, response_format, messages):
        assert (model, temperature, response_format["type"], messages[0]) == ("m", 0, "json_object", {"role": "system", "content": "rules"})
        return Has(choices=[Has(message=Has(content=ANSWER if "a.doc" in messages[1]["content"] else "nothing"))])

    def embed(model, input, dimensions):
        vectors = [Has(index=i, embedding=[float(len(t))] * dimensions) for i, t in enumerate(input)]
        return Has(data=vectors[::-1])

    return Has(chat=Has(completions=Has(create=create)), embeddings=Has(create=embed))


def anthropic_client():
    def create(model, max_tokens, system, messages):
        assert system == "rules" and [m["role"] for m in messages] == ["user"]
        return Has(content=[Has(text=f"```json\n{ANSWER}\n```")])

    return Has(messages=Has(create=create))


def ollama_client():
    def post(path, payload):
        assert path == "/api/chat" and payload["stream"] is False and payload["messages"][1]["content"].endswith("long enough " * 4)
        return {"message": {"content": ANSWER}}

    return post


@pytest.mark.parametrize(("name", "client"), [("openai", openai_client), ("anthropic", anthropic_client), ("ollama", ollama_client)])
def test_extraction_by_name(spark, name, client):
    docs = spark.createDataFrame([("a", "a.doc", "long enough " * 4)], "source_rel string, source_file string, text string")
    row = requirements.extracted(docs, providers.Extractor(name, "m", client, "rules")).first()
    assert row.error is None and row.requirements[0].req_name == "n"


def test_the_client_is_made_once():
    made = []

    def client():
        made.append(1)
        return anthropic_client()

    ask = providers.Extractor("anthropic", "m", client, "rules")
    assert ask("text", "f") == ask("more", "g") and len(made) == 1 and ask.__getstate__()["made"] == []


def test_unknown_names():
    with pytest.raises(ValueError, match="no provider 'x'"):
        providers.Extractor("x", "m", dict, "")
    with pytest.raises(ValueError, match="no provider 'x'"):
        providers.embedder("x", "m", dict, 2)


def test_a_server_is_posted_to():
    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"path": self.path, "asked": asked}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    Thread(target=server.handle_request, daemon=True).start()
    assert providers.posting(f"http://127.0.0.1:{server.server_port}", 10)("/api/chat", {"a": 1}) == {"path": "/api/chat", "asked": {"a": 1}}
    server.server_close()


def test_embedding_by_name(spark):
    docs = spark.createDataFrame([(k, "x" * k, k) for k in range(1, 8)], "id long, text string, n long")
    got = embedding.embedded(docs, providers.embedder("openai", "m", openai_client, 3), 3, batch=4).collect()
    assert all(r.embedding == [float(r.id)] * 3 for r in got)
    got = embedding.embedded_by_budget(docs, ["id"], "n", providers.embedder("openai", "m", openai_client, 3), 3, max_tokens=9, rate=6e8, requests=6e6, workers=2).collect()
    assert all(r.embedding == [float(r.id)] * 3 for r in got) and len(got) == 7
    local = providers.embedder("local", "m", lambda: Has(encode=lambda texts, normalize_embeddings: np.ones((len(texts), 2)) * normalize_embeddings), 2)
    assert embedding.embedded(docs, local, 2).where(F.col("embedding")[0] == 1).count() == 7


def test_a_service_that_loses_vectors_is_not_believed():
    short = Has(embeddings=Has(create=lambda model, input, dimensions: Has(data=[])))
    with pytest.raises(ValueError, match="0 vectors for 1 texts"):
        providers.embedder("openai", "m", lambda: short, 2)()(["a"])
