"""What test modules import by name: a conftest is found by its folder, so its names are not for importing."""

SF = "/root/testdata/sf0.001"


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))
