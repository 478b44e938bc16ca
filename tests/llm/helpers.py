"""Small tables for the tests of the corpus operators."""

import pyarrow as pa
import pyarrow.parquet as pq

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows(texts, start=0):
    return [(start + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def doc_table(spark, rows):
    return spark.createDataFrame(rows, DOCUMENT)


def write_documents(folder, rows):
    """A folder like the driver's, with one table."""
    names = [c.split()[0] for c in DOCUMENT.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    arrays = [pa.array(list(c), type=k) for c, k in zip(columns, kinds)]
    pq.write_table(pa.Table.from_arrays(arrays, names), f"{folder}/documents.parquet")
    return str(folder)


def smallest_reachable(nodes, linked):
    """Brute-force components: by node, the smallest one reachable."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if label[b] < label[a] and linked(a, b):
                    label[a] = label[b]
                    changed = True
    return label
