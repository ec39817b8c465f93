"""Plug-ins that misbehave on purpose."""


class FlakyEmbedder:
    """Fails on texts that contain 'poison'; equal instances share a loaded model."""

    def __eq__(self, other):
        return type(self) is type(other)

    def __hash__(self):
        return hash("flaky")

    def __call__(self):
        def encode(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("cannot embed")
            return [[float(len(t)), 1.0] for t in texts]

        return encode


class FlakyGenerator:
    def __eq__(self, other):
        return type(self) is type(other)

    def __hash__(self):
        return hash("flaky generator")

    def __call__(self):
        def reply(messages):
            if "poison" in messages[-1]["content"]:
                raise ValueError("no answer")
            return f"  {len(messages)} seen ", None if "free" in messages[-1]["content"] else 2_999_999

        return reply


def two_column_pages(payload):
    """Page extractor with a metadata title: 'title|page|page...'."""
    title, *pages = payload.decode("utf-8").split("|")
    return title, pages
