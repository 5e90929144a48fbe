"""A plain-Python model of the event cleaners, written from their stated
semantics, used as the expected value in tests."""

MV = "__mv_"


def _empty(v):
    return v is None or v == ""


def model_clean(value, drop_key, drop_if_empty, drop_empty_elements):
    if isinstance(value, list):
        kept = [x for x in value if not (drop_empty_elements and _empty(x))]
        return [model_clean(x, drop_key, drop_if_empty, drop_empty_elements) for x in kept]
    if isinstance(value, dict):
        return {
            k: model_clean(v, drop_key, drop_if_empty, drop_empty_elements)
            for k, v in value.items()
            if not (drop_key(k) or (drop_if_empty(k) and _empty(v)))
        }
    return value


def c1(v):
    return model_clean(v, lambda k: k.startswith(MV), lambda k: False, False)


def c2(v):
    return model_clean(v, lambda k: False, lambda k: True, True)


def c3(v):
    return model_clean(v, lambda k: False, lambda k: k.startswith(MV), True)


def c4(v):
    return model_clean(v, lambda k: k == "_raw", lambda k: False, False)


def c5(v):
    """The alert action applies the four cleaners in sequence."""
    return c4(c3(c2(c1(v))))
