"""Rows of a Spark query and of its SQL, as comparable lists."""


def plain(value):
    return tuple(map(plain, value)) if isinstance(value, list) else value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(relation):
    names = sorted(relation.columns)
    rows = [dict(zip(relation.columns, r, strict=True)) for r in relation.fetchall()]
    return names, sorted((tuple(plain(r[n]) for n in names) for r in rows), key=repr)
