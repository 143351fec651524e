"""A client that stands in for a model: it quotes the first sentence of what it is shown, and counts its calls in a folder."""

import os
import uuid

CALLS = "STANDIN_CALLS"


class Client:
    def complete_json(self, *, model, system, user, schema, key):
        if os.environ.get(CALLS):
            open(os.path.join(os.environ[CALLS], uuid.uuid4().hex), "w").close()
        if "verdict" in schema["properties"]:
            return {"verdict": "SUPPORTED", "confidence": 0.875, "reasoning": "stands there"}
        text = user.split("EXCERPT:\n", 1)[1]
        quote = text.split(". ")[0] + "."
        return {"qa_pairs": [{"question": f"What does part {sum(map(ord, text)) % 10_007} of {len(text)} say?", "answer": quote, "source_passage": quote, "question_type": "fact_extraction", "difficulty": "easy"}]}


def make(cfg):
    return Client()
