import math


def rows_of(frame):
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
            return "null"
        if hasattr(v, "tolist"):
            v = v.tolist()
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))
