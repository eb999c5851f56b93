"""Write small XML files of records."""

from xml.sax.saxutils import escape


def record(kind, values, extra=""):
    children = "".join(
        f"<{element}>{escape(str(value))}</{element}>"
        for element, value in zip(kind.elements, values, strict=True)
        if value is not None
    )
    return f"<record>{children}{extra}</record>"


def document(records, closed=True):
    body = "\n".join(records)
    end = "\n</records>\n" if closed else ""
    return f"<?xml version='1.0' encoding='UTF-8'?>\n<records>\n{body}{end}"


def write(path, records, closed=True):
    path.write_text(document(records, closed), encoding="utf-8")
    return str(path)


def employee(ident, fio="A B C", date="2024-01-01", region=1):
    return (ident, fio, region, 2, 3, 4, 5, "1990-02-03", date, "u1", 9)


def region(ident, name="R", population="2.5", f_value=""):
    return (name, ident, "P", population, "N", 1, 2, 3, f_value)


def company(ident, kind="T", industry="I"):
    return (ident, "C", "P", 1, kind, industry, 5, "2020-01-01", "2020-01-02 03:04:05", "77")
