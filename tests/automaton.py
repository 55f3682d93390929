"""The matching rules as a plain event loop, to test the distributed operator against."""


def match(events, timeout_us):
    """events: (key, us, ord, id) with ord 0 request, 1 response -> set of (key, request id, response id)."""
    waiting, pairs = {}, set()
    for key, us, ord_, id_ in sorted(events, key=lambda e: (e[1], e[2], e[3])):
        held = waiting.get(key)
        if held and timeout_us is not None and us - held[0] > timeout_us:
            held = waiting.pop(key) and None
        if ord_ == 0:
            if not held:
                waiting[key] = (us, id_)
        elif held:
            pairs.add((key, held[1], id_))
            del waiting[key]
    return pairs
