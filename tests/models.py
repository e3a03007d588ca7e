"""Stand-in models for the scorer hook; module-level, so that workers import them."""

import tempfile


def keyword_model():
    def score(texts):
        out = []
        for text in texts:
            if "boom" in text:
                raise RuntimeError("model failed")
            if "good" in text:
                out.append(("POSITIVE", 0.92004))
            elif "bad" in text:
                out.append(("NEGATIVE", 0.78))
            else:
                out.append(("neutral", 0.99))
        return out

    return score


def length_model():
    return lambda texts: [("positive", len(t) / 10000) for t in texts]


def first_letter_model():
    return lambda texts: [(f"starts with {t[:1]}, {len(t)} long", 1.0) for t in texts]


def load_counter(folder):
    """Count the calls of the model in files, one per call, to see what was scored."""

    def load():
        def score(texts):
            for text in texts:
                with tempfile.NamedTemporaryFile(dir=folder, delete=False) as f:
                    f.write(text.encode())
            return [("positive", 1.0) for _ in texts]

        return score

    return load


def broken_model():
    def score(texts):
        raise RuntimeError("no weights")

    return score


def device_model(device):
    return lambda texts: [(device, 1.0) for _ in texts]
