"""Character dictionaries, example encoding and the two character networks.

Training names are the parts, labelled with their brand; customers with their market segment
serve as the further views of the dictionaries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.plans import batches, characters, networks
from corpusml.queries.base import Catalog, entities, more_entities, places, sql_digest, sql_places

catalog = Catalog()

MAX_LEN = 10
#: The networks read whole names; a longer one is an error.
NAME_LEN = 16
STEPS = 4
EPOCHS = 2
RATE = 0.5

_CHARS = """
    chars AS (SELECT char, CAST(row_number() OVER (ORDER BY char <> ' ', char) - 1 AS INTEGER) AS char_id
              FROM (SELECT DISTINCT unnest(string_split(name, '')) AS char
                    FROM (SELECT p_name AS name FROM part UNION ALL SELECT c_name FROM customer)
                    UNION SELECT ' ')),
    labels AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
               FROM (SELECT DISTINCT p_brand AS label FROM part))"""

# Every character of a part name with its position, and the encoded names.
_PLACED = f"""{_CHARS},
    placed AS (SELECT idx, pos, char_id
               FROM (SELECT p_partkey AS idx, unnest(string_split(p_name, '')) AS char,
                            unnest(range(0, length(p_name))) AS pos FROM part) JOIN chars USING (char))"""


def _dictionaries(spark, sf_dir):
    train, other = entities(spark, sf_dir), more_entities(spark, sf_dir)
    return train, *characters.dictionaries(train, other, labelled=[train])


def _encoded(spark, sf_dir):
    return characters.encode(*_dictionaries(spark, sf_dir))


@catalog.add(f"WITH {_CHARS} SELECT char, char_id FROM chars")
def char_vocab(spark, sf_dir):
    return _dictionaries(spark, sf_dir)[1]


@catalog.add("""
    SELECT unnest(string_split(c_name, '')) AS char FROM customer
    EXCEPT SELECT unnest(string_split(p_name, '')) FROM part
    EXCEPT SELECT unnest(string_split(s_name, '')) FROM supplier
""")
def unseen_characters(spark, sf_dir):
    from corpusml.queries.base import table

    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("entity"))
    return characters.unseen_characters(more_entities(spark, sf_dir), entities(spark, sf_dir), suppliers)


@catalog.add(f"WITH {_CHARS} SELECT label, label_id FROM labels")
def label_dict(spark, sf_dir):
    return _dictionaries(spark, sf_dir)[2]


@catalog.add(f"""
    WITH {_PLACED}
    SELECT idx, chars, label_id
    FROM (SELECT idx, string_agg(CAST(char_id AS VARCHAR), ',' ORDER BY pos) AS chars FROM placed GROUP BY idx)
    JOIN part ON p_partkey = idx JOIN labels ON label = p_brand
""")
def char_encode(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "idx", F.array_join(F.col("chars").cast("array<string>"), ",").alias("chars"), F.col("labels")[0].alias("label_id")
    )


@catalog.add("SELECT c_custkey AS idx, CAST(0 AS INTEGER) AS label_id FROM customer")
def unknown_label_default(spark, sf_dir):
    train, chars, labels = _dictionaries(spark, sf_dir)
    test = characters.encode(more_entities(spark, sf_dir), chars, labels)
    return test.select("idx", F.col("labels")[0].alias("label_id"))


@catalog.add(f"""
    WITH {_PLACED}
    SELECT idx, string_agg(CAST(pos * (SELECT count(*) FROM chars) + char_id AS VARCHAR), ',' ORDER BY pos) AS ones
    FROM placed WHERE pos < {MAX_LEN} GROUP BY idx
""")
def char_onehot_index(spark, sf_dir):
    train, chars, labels = _dictionaries(spark, sf_dir)
    ones = characters.one_hot_positions("chars", MAX_LEN, chars.count())
    encoded = characters.encode(train, chars, labels)
    return encoded.select("idx", F.array_join(ones.cast("array<string>"), ",").alias("ones"))


@catalog.add(f"""
    WITH {_PLACED}
    SELECT idx, string_agg(coalesce(CAST(char_id AS VARCHAR), '-'), ',' ORDER BY pos DESC) AS steps
    FROM (SELECT p_partkey AS idx, unnest(range(0, {MAX_LEN})) AS pos FROM part) LEFT JOIN placed USING (idx, pos)
    GROUP BY idx
""")
def char_reversed_steps(spark, sf_dir):
    steps = characters.steps("chars", MAX_LEN).cast("array<string>")
    return _encoded(spark, sf_dir).select("idx", F.array_join(steps, ",", "-").alias("steps"))


@catalog.add(f"""
    WITH {_CHARS}
    SELECT p_partkey AS idx, l.label_id, CASE WHEN l.label = p_brand THEN 1.0 ELSE 0.0 END AS y
    FROM part CROSS JOIN labels l
""")
def label_multi_hot(spark, sf_dir):
    train, chars, labels = _dictionaries(spark, sf_dir)
    encoded = characters.encode(train, chars, labels)
    y = characters.multi_hot("labels", labels.count())
    return encoded.select("idx", F.posexplode(y).alias("label_id", "y"))


@catalog.add(f"""
    SELECT idx, rank, CAST(rank // 64 AS INTEGER) AS batch
    FROM (SELECT p_partkey AS idx, row_number() OVER (ORDER BY {sql_digest("'3:1:' || p_partkey")}, p_partkey) - 1 AS rank
          FROM part)
""")
def minibatch_assign(spark, sf_dir):
    return batches.assign(entities(spark, sf_dir).select("idx"), "idx", 64, seed=3, epoch=1)


def _hashed_parameters(model: networks.Model, shape: networks.Shape) -> networks.Parameters:
    """Parameters that SQL can compute as well: a hash of name and place in [-0.5, 0.5)."""
    import hashlib

    import numpy as np

    def value(name: str, *place: int) -> float:
        text = ":".join([name, *map(str, place)])
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32 - 0.5

    return {
        name: np.array([value(name, *place) for place in np.ndindex(*like.shape)]).reshape(like.shape)
        for name, like in model.initial(shape, 0).items()
    }


_HIDDEN = 4
_UNIT = sql_digest("{}") + " / 4294967296.0 - 0.5"
_W1 = _UNIT.format("'w1:' || (pos * (SELECT count(*) FROM chars) + char_id) || ':' || h")

_FORWARD = f"""
    WITH {_PLACED},
    hid AS (SELECT unnest(range(0, {_HIDDEN})) AS h),
    o1 AS MATERIALIZED (
        SELECT idx, h, greatest(0.0, sum({_W1}) + any_value({_UNIT.format("'b1:' || h")})) AS v
        FROM placed CROSS JOIN hid WHERE pos < {NAME_LEN} GROUP BY idx, h),
    o2 AS MATERIALIZED (
        SELECT idx, label_id, greatest(0.0, sum(v * ({_UNIT.format("'w2:' || h || ':' || label_id")}))
                                            + any_value({_UNIT.format("'b2:' || label_id")})) AS v
        FROM o1 CROSS JOIN labels GROUP BY idx, label_id),
    probs AS MATERIALIZED (
        SELECT idx, label_id, exp(v) / sum(exp(v)) OVER (PARTITION BY idx) AS p, v > 0 AS open FROM o2),
    truth AS (SELECT p_partkey AS idx, label_id AS true_id FROM part JOIN labels ON label = p_brand)"""


def _prepared(spark, sf_dir, model: networks.Model, hidden: int = 50):
    train, chars, labels = _dictionaries(spark, sf_dir)
    shape = networks.Shape(chars.count(), labels.count(), NAME_LEN, hidden)
    encoded = characters.encode(train, chars, labels)
    too_long = F.raise_error(F.lit(f"a name has more than {NAME_LEN} characters"))
    encoded = encoded.withColumn("chars", F.when(F.size("chars") <= NAME_LEN, F.col("chars")).otherwise(too_long))
    return networks.prepare(encoded, shape, model), shape


@catalog.add(f"""
    {_FORWARD} SELECT probs.idx, label_id, {sql_places("p")} AS p FROM probs
""")
def mlp_probabilities(spark, sf_dir):
    examples, shape = _prepared(spark, sf_dir, networks.MLP, _HIDDEN)
    scored = networks.predict(examples, networks.MLP, shape, _hashed_parameters(networks.MLP, shape))
    flat = scored.select("idx", F.posexplode("probs").alias("label_id", "p"))
    return flat.withColumn("p", places("p"))


@catalog.add(f"""
    {_FORWARD}, err AS (
        SELECT probs.idx, label_id, CASE WHEN open THEN p - CASE WHEN label_id = true_id THEN 1.0 ELSE 0.0 END ELSE 0.0 END AS e,
               CASE WHEN label_id = true_id THEN -ln(p) ELSE 0.0 END AS loss
        FROM probs JOIN truth USING (idx)),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM part),
    back AS MATERIALIZED (
        SELECT idx, h, CASE WHEN any_value(v) > 0 THEN sum(e * ({_UNIT.format("'w2:' || h || ':' || label_id")})) ELSE 0.0 END AS g
        FROM err JOIN o1 USING (idx) GROUP BY idx, h)
    SELECT 'loss' AS slot, {sql_places("sum(loss) / any_value(n.n)")} AS v FROM err, n
    UNION ALL
    SELECT 'b2:' || label_id, {sql_places("sum(e) / any_value(n.n)")} FROM err, n GROUP BY label_id
    UNION ALL
    SELECT 'w2:' || h || ':' || label_id, {sql_places("sum(v * e) / any_value(n.n)")}
    FROM err JOIN o1 USING (idx), n GROUP BY h, label_id
    UNION ALL
    SELECT 'b1:' || h, {sql_places("sum(g) / any_value(n.n)")} FROM back, n GROUP BY h
    UNION ALL
    SELECT 'w1:' || (pos * (SELECT count(*) FROM chars) + char_id) || ':' || h, {sql_places("sum(g) / any_value(n.n)")}
    FROM placed JOIN back USING (idx), n WHERE pos < {NAME_LEN} GROUP BY pos, char_id, h
""")
def mlp_gradient(spark, sf_dir):
    examples, shape = _prepared(spark, sf_dir, networks.MLP, _HIDDEN)
    loss, _, grad = networks.evaluate(examples, networks.MLP, shape, _hashed_parameters(networks.MLP, shape), True)
    rows = [("loss", loss)]
    for name in ("b1", "b2", "w2"):
        rows += [(":".join([name, *map(str, at)]), float(v)) for at, v in _indexed(grad[name])]
    # A place and character that no name has got no gradient, and no row in SQL.
    used = grad["w1"].any(axis=1)
    rows += [(f"w1:{i}:{h}", float(v)) for (i, h), v in _indexed(grad["w1"]) if used[i]]
    out = spark.createDataFrame(rows, "slot string, v double")
    return out.withColumn("v", places("v"))


def _indexed(array):
    import numpy as np

    return np.ndenumerate(array)


_GATES = networks.GATES


def _unit(text: str) -> str:
    return "(" + _UNIT.format(text) + ")"


def _lstm_sql() -> str:
    """The recurrent layer unrolled: one table of hidden and cell values per step."""
    each = lambda pattern: ", ".join(pattern.format(g=g) for g in _GATES)
    sigmoid = "1.0 / (1.0 + exp(-({0})))"
    gate = {g: f"(r{g} + b{g} + coalesce(w{g}, 0.0))" for g in _GATES}
    parts = [
        f"WITH {_PLACED}",
        f"hid AS (SELECT unnest(range(0, {_HIDDEN})) AS h)",
        "ww AS MATERIALIZED (SELECT char_id, h, " + each("{{}} AS w{g}").format(
            *[_unit(f"'w{g}:' || char_id || ':' || h") for g in _GATES]) + " FROM chars CROSS JOIN hid)",
        "uu AS MATERIALIZED (SELECT a.h AS k, b.h AS h, " + each("{{}} AS u{g}").format(
            *[_unit(f"'u{g}:' || a.h || ':' || b.h") for g in _GATES]) + " FROM hid a CROSS JOIN hid b)",
        "bb AS MATERIALIZED (SELECT h, " + each("{{}} AS b{g}").format(
            *[_unit(f"'b{g}:' || h") for g in _GATES]) + " FROM hid)",
        "s0 AS (SELECT p_partkey AS idx, h, 0.0::DOUBLE AS hv, 0.0::DOUBLE AS cv FROM part CROSS JOIN hid)",
    ]
    for t in range(1, NAME_LEN + 1):
        parts.append(f"""s{t} AS MATERIALIZED (
            SELECT idx, h, {sigmoid.format(gate["o"])} * tanh(c) AS hv, c AS cv FROM (
                SELECT *, {sigmoid.format(gate["f"])} * cv + {sigmoid.format(gate["i"])} * tanh({gate["c"]}) AS c
                FROM (SELECT idx, uu.h, {each("sum(hv * u{g}) AS r{g}")} FROM s{t - 1} JOIN uu ON uu.k = s{t - 1}.h
                      GROUP BY idx, uu.h)
                JOIN s{t - 1} USING (idx, h) JOIN bb USING (h)
                LEFT JOIN (SELECT idx, char_id FROM placed WHERE pos = {NAME_LEN - t}) USING (idx)
                LEFT JOIN ww USING (char_id, h)))""")
    parts.append(f"""o2 AS MATERIALIZED (
        SELECT idx, label_id, greatest(0.0, sum(hv * {_unit("'w2:' || h || ':' || label_id")})
                                            + any_value({_unit("'b2:' || label_id")})) AS v
        FROM s{NAME_LEN} CROSS JOIN labels GROUP BY idx, label_id)""")
    return ",\n".join(parts)


@catalog.add(f"""
    {_lstm_sql()}
    SELECT idx, label_id, {sql_places("exp(v) / sum(exp(v)) OVER (PARTITION BY idx)")} AS p FROM o2
""")
def lstm_probabilities(spark, sf_dir):
    examples, shape = _prepared(spark, sf_dir, networks.LSTM, _HIDDEN)
    scored = networks.predict(examples, networks.LSTM, shape, _hashed_parameters(networks.LSTM, shape))
    flat = scored.select("idx", F.posexplode("probs").alias("label_id", "p"))
    return flat.withColumn("p", places("p"))


def _lstm_start() -> list[str]:
    """The hashed start parameters as tables of round 0, and the character that each step reads."""
    each = lambda pattern: ", ".join(f"{_unit(pattern.format(g=g))} AS {g}" for g in _GATES)
    return [
        f"WITH {_PLACED}", f"hid AS (SELECT unnest(range(0, {_HIDDEN})) AS h)",
        "size AS (SELECT CAST(ceil(count(*) / %d.0) AS BIGINT) AS batch FROM part)" % STEPS,
        "truth AS (SELECT p_partkey AS idx, label_id AS true_id FROM part JOIN labels ON label = p_brand)",
        f"reads AS MATERIALIZED (SELECT idx, {NAME_LEN} - pos AS t, char_id FROM placed)",
        "w_0 AS MATERIALIZED (SELECT char_id, h, " + each("'w{g}:' || char_id || ':' || h") + " FROM chars CROSS JOIN hid)",
        "u_0 AS MATERIALIZED (SELECT a.h AS k, b.h AS h, " + each("'u{g}:' || a.h || ':' || b.h") + " FROM hid a CROSS JOIN hid b)",
        "b_0 AS MATERIALIZED (SELECT h, " + each("'b{g}:' || h") + " FROM hid)",
        f"w2_0 AS MATERIALIZED (SELECT h, label_id, {_unit("'w2:' || h || ':' || label_id")} AS v FROM hid CROSS JOIN labels)",
        f"b2_0 AS MATERIALIZED (SELECT label_id, {_unit("'b2:' || label_id")} AS v FROM labels)",
    ]


def _lstm_forward(name: str, r: int, rows: str) -> list[str]:
    """Gates, cells and outputs of every step, then the probabilities, for the names of a table."""
    sigmoid = lambda x: f"1.0 / (1.0 + exp(-({x})))"
    raw = {g: f"(r.{g} + b.{g} + coalesce(w.{g}, 0.0))" for g in _GATES}
    # s: outputs and cells after a step, with the gates (gi, gf, go, gc), the cell before (was) and its tanh (sq).
    parts = [f"""s_{name}_0 AS MATERIALIZED (
        SELECT idx, h, 0.0::DOUBLE AS hv, 0.0::DOUBLE AS cell, 0.0::DOUBLE AS gi, 0.0::DOUBLE AS gf, 0.0::DOUBLE AS go, 0.0::DOUBLE AS gc,
               0.0::DOUBLE AS was, 0.0::DOUBLE AS sq FROM {rows} CROSS JOIN hid)"""]
    for t in range(1, NAME_LEN + 1):
        sums = ", ".join(f"sum(hv * u.{g}) AS {g}" for g in _GATES)
        parts.append(f"""s_{name}_{t} AS MATERIALIZED (
            SELECT idx, h, go * tanh(cell) AS hv, cell, gi, gf, go, gc, was, tanh(cell) AS sq
            FROM (SELECT *, gf * was + gi * gc AS cell FROM (
                SELECT r.idx, r.h, {sigmoid(raw["i"])} AS gi, {sigmoid(raw["f"])} AS gf, {sigmoid(raw["o"])} AS go, tanh({raw["c"]}) AS gc, p.cell AS was
                FROM (SELECT idx, u.h, {sums} FROM s_{name}_{t - 1} s JOIN u_{r} u ON u.k = s.h GROUP BY idx, u.h) r
                JOIN s_{name}_{t - 1} p ON p.idx = r.idx AND p.h = r.h JOIN b_{r} b ON b.h = r.h
                LEFT JOIN (SELECT idx, char_id FROM reads WHERE t = {t}) x ON x.idx = r.idx
                LEFT JOIN w_{r} w ON w.char_id = x.char_id AND w.h = r.h)))""")
    last = f"s_{name}_{NAME_LEN}"
    parts.append(f"""o2_{name} AS MATERIALIZED (
        SELECT idx, label_id, sum(hv * w.v) + any_value(b.v) AS raw FROM {last} JOIN w2_{r} w USING (h) JOIN b2_{r} b USING (label_id) GROUP BY idx, label_id)""")
    parts.append(f"""p_{name} AS MATERIALIZED (
        SELECT idx, label_id, raw, exp(greatest(0.0, raw)) / sum(exp(greatest(0.0, raw))) OVER (PARTITION BY idx) AS p, label_id = true_id AS hit
        FROM o2_{name} JOIN truth USING (idx))""")
    return parts


def _lstm_backward(name: str, r: int) -> list[str]:
    """Errors of every gate, step by step from the end: ``d_<name> (t, idx, h, i, f, o, c)``."""
    parts = [
        f"e_{name} AS MATERIALIZED (SELECT idx, label_id, CASE WHEN raw > 0 THEN p - CASE WHEN hit THEN 1.0 ELSE 0.0 END ELSE 0.0 END AS e FROM p_{name})",
        f"""k_{name}_{NAME_LEN} AS MATERIALIZED (
            SELECT idx, h, sum(e * v) AS back, 0.0::DOUBLE AS cell FROM e_{name} JOIN w2_{r} USING (label_id) GROUP BY idx, h)"""]
    for t in range(NAME_LEN, 0, -1):
        parts.append(f"""d_{name}_{t} AS MATERIALIZED (
            SELECT idx, h, dc * gc * gi * (1 - gi) AS i, dc * was * gf * (1 - gf) AS f, back * sq * go * (1 - go) AS o, dc * gi * (1 - gc * gc) AS c, dc * gf AS cell
            FROM (SELECT s.*, k.back, k.cell + k.back * go * (1 - sq * sq) AS dc FROM s_{name}_{t} s JOIN k_{name}_{t} k ON k.idx = s.idx AND k.h = s.h))""")
        if t > 1:
            parts.append(f"""k_{name}_{t - 1} AS MATERIALIZED (
                SELECT b.idx, b.h, b.back, d.cell
                FROM (SELECT idx, u.k AS h, sum(d.i * u.i + d.f * u.f + d.o * u.o + d.c * u.c) AS back FROM d_{name}_{t} d JOIN u_{r} u ON u.h = d.h GROUP BY idx, u.k) b
                JOIN d_{name}_{t} d ON d.idx = b.idx AND d.h = b.h)""")
    parts.append(f"d_{name} AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {t} AS t, idx, h, i, f, o, c FROM d_{name}_{t}" for t in range(1, NAME_LEN + 1)) + ")")
    parts.append(f"z_{name} AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {t} AS t, idx, h AS k, hv FROM s_{name}_{t - 1}" for t in range(1, NAME_LEN + 1)) + ")")
    return parts


def _lstm_gradient_sql() -> str:
    parts = [*_lstm_start(), *_lstm_forward("x", 0, "truth"), *_lstm_backward("x", 0), "n AS (SELECT count(*)::DOUBLE AS n FROM part)"]
    slots = ["SELECT 'loss' AS slot, " + sql_places("sum(-ln(p)) / any_value(n.n)") + " AS v FROM p_x, n WHERE hit",
             f"SELECT 'b2:' || label_id, {sql_places("sum(e) / any_value(n.n)")} FROM e_x, n GROUP BY label_id",
             f"SELECT 'w2:' || h || ':' || label_id, {sql_places("sum(hv * e) / any_value(n.n)")} FROM s_x_{NAME_LEN} JOIN e_x USING (idx), n GROUP BY h, label_id"]
    for g in _GATES:
        mean = sql_places(f"sum(d_x.{g}) / any_value(n.n)")
        slots += [f"SELECT 'b{g}:' || h, {mean} FROM d_x, n GROUP BY h",
                  f"SELECT 'w{g}:' || char_id || ':' || h, {mean} FROM d_x JOIN reads USING (idx, t), n GROUP BY char_id, h",
                  f"SELECT 'u{g}:' || k || ':' || h, {sql_places(f'sum(hv * d_x.{g}) / any_value(n.n)')} FROM d_x JOIN z_x USING (idx, t), n GROUP BY k, h"]
    return ",\n".join(parts) + "\n" + "\nUNION ALL ".join(slots)


@catalog.add(_lstm_gradient_sql())
def lstm_gradient(spark, sf_dir):
    """Mean loss and gradient of the recurrent model at hashed parameters."""
    examples, shape = _prepared(spark, sf_dir, networks.LSTM, _HIDDEN)
    loss, _, grad = networks.evaluate(examples, networks.LSTM, shape, _hashed_parameters(networks.LSTM, shape), True)
    rows = [("loss", loss)]
    for name, values in grad.items():
        # A character that no name has got no gradient, and no row in SQL.
        used = values.any(axis=1) if name in {f"w{g}" for g in _GATES} else [True] * len(values)
        rows += [(":".join([name, *map(str, at)]), float(v)) for at, v in _indexed(values) if used[at[0]]]
    return spark.createDataFrame(rows, "slot string, v double").withColumn("v", places("v"))


def _trained(spark, sf_dir, model: networks.Model):
    """Two epochs of a few large batches."""
    examples, shape = _prepared(spark, sf_dir, model, _HIDDEN)
    examples = networks.materialize(examples, "query-examples")
    settings = networks.Settings(epochs=EPOCHS, steps=STEPS, learning_rate=RATE)
    return examples, shape, networks.train(examples, examples, model, shape, settings, _hashed_parameters(model, shape))


def _train_predict(spark, sf_dir, model: networks.Model):
    """The probabilities of every training name after training."""
    examples, shape, trained = _trained(spark, sf_dir, model)
    scored = networks.predict(examples, model, shape, trained.parameters)
    best = F.array_max(F.transform("probs", lambda p, i: F.struct(p.alias("p"), (-i).alias("i"))))
    return scored.select("idx", (-best["i"]).alias("label_id"), places(best["p"]).alias("p"), places("loss").alias("loss"))


def _mlp_rounds() -> str:
    """The rounds of training the perceptron, one set of parameter tables per round."""
    parts = [f"WITH {_PLACED}", f"hid AS (SELECT unnest(range(0, {_HIDDEN})) AS h)",
        "size AS (SELECT (SELECT count(*) FROM chars) AS c, CAST(ceil(count(*) / %d.0) AS BIGINT) AS batch FROM part)" % STEPS,
        "truth AS (SELECT p_partkey AS idx, label_id AS true_id FROM part JOIN labels ON label = p_brand)",
        "seen AS MATERIALIZED (SELECT idx, pos * c + char_id AS i FROM placed, size)",
        f"w1_0 AS MATERIALIZED (SELECT i, h, {_unit("'w1:' || i || ':' || h")} AS v FROM (SELECT DISTINCT i FROM seen) CROSS JOIN hid)",
        f"b1_0 AS MATERIALIZED (SELECT h, {_unit("'b1:' || h")} AS v FROM hid)",
        f"w2_0 AS MATERIALIZED (SELECT h, label_id, {_unit("'w2:' || h || ':' || label_id")} AS v FROM hid CROSS JOIN labels)",
        f"b2_0 AS MATERIALIZED (SELECT label_id, {_unit("'b2:' || label_id")} AS v FROM labels)"]

    def forward(name: str, r: int, rows: str) -> None:
        parts.extend([
            f"""o1_{name} AS MATERIALIZED (
                SELECT idx, h, sum(w.v) + any_value(b.v) AS raw
                FROM seen JOIN {rows} USING (idx) JOIN w1_{r} w USING (i) JOIN b1_{r} b USING (h) GROUP BY idx, h)""",
            f"""o2_{name} AS MATERIALIZED (
                SELECT idx, label_id, sum(greatest(0.0, raw) * w.v) + any_value(b.v) AS raw
                FROM o1_{name} JOIN w2_{r} w USING (h) JOIN b2_{r} b USING (label_id) GROUP BY idx, label_id)""",
            f"""p_{name} AS MATERIALIZED (
                SELECT idx, label_id, raw, exp(greatest(0.0, raw)) / sum(exp(greatest(0.0, raw))) OVER (PARTITION BY idx) AS p, label_id = true_id AS hit
                FROM o2_{name} JOIN truth USING (idx))"""])

    r = 0
    for epoch in range(EPOCHS):
        parts.append(f"""order_{epoch} AS MATERIALIZED (
            SELECT p_partkey AS idx, (row_number() OVER (ORDER BY {sql_digest(f"'0:{epoch}:' || p_partkey")}, p_partkey) - 1) // size.batch AS batch
            FROM part, size)""")
        for batch in range(STEPS):
            parts.append(f"m_{r} AS (SELECT idx FROM order_{epoch} WHERE batch = {batch})")
            forward(str(r), r, f"m_{r}")
            step = f"{RATE} / (SELECT count(*) FROM m_{r})"
            parts.extend([
                f"e_{r} AS MATERIALIZED (SELECT idx, label_id, CASE WHEN raw > 0 THEN p - CASE WHEN hit THEN 1.0 ELSE 0.0 END ELSE 0.0 END AS e FROM p_{r})",
                f"""k_{r} AS MATERIALIZED (
                    SELECT idx, h, CASE WHEN any_value(o.raw) > 0 THEN sum(e * w.v) ELSE 0.0 END AS g
                    FROM e_{r} JOIN o1_{r} o USING (idx) JOIN w2_{r} w USING (h, label_id) GROUP BY idx, h)""",
                f"b2_{r + 1} AS MATERIALIZED (SELECT label_id, any_value(b.v) - {step} * sum(e) AS v FROM b2_{r} b JOIN e_{r} USING (label_id) GROUP BY label_id)",
                f"""w2_{r + 1} AS MATERIALIZED (
                    SELECT h, label_id, any_value(w.v) - {step} * sum(greatest(0.0, o.raw) * e) AS v
                    FROM w2_{r} w JOIN e_{r} USING (label_id) JOIN o1_{r} o USING (idx, h) GROUP BY h, label_id)""",
                f"b1_{r + 1} AS MATERIALIZED (SELECT h, any_value(b.v) - {step} * sum(g) AS v FROM b1_{r} b JOIN k_{r} USING (h) GROUP BY h)",
                f"""w1_{r + 1} AS MATERIALIZED (
                    SELECT i, h, w.v - {step} * coalesce(g, 0.0) AS v FROM w1_{r} w LEFT JOIN (
                        SELECT i, h, sum(g) AS g FROM seen JOIN k_{r} USING (idx) GROUP BY i, h) USING (i, h))"""])
            r += 1
        forward(f"epoch{epoch}", r, "truth")
        parts.append(f"loss_{epoch} AS (SELECT avg(-ln(p)) AS loss FROM p_epoch{epoch} WHERE hit)")
    return ",\n".join(parts)


# The first epoch with the least validation loss is kept.
_BEST = "SELECT epoch FROM (" + " UNION ALL ".join(f"SELECT {e} AS epoch, loss FROM loss_{e}" for e in range(EPOCHS)) + ") ORDER BY loss, epoch LIMIT 1"
_ALL_EPOCHS = " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM p_epoch{e}" for e in range(EPOCHS))


_PREDICTED = f"""
    SELECT idx, CAST(arg_max(label_id, (p, -label_id)) AS INTEGER) AS label_id, {sql_places("max(p)")} AS p, {sql_places("sum(CASE WHEN hit THEN -ln(p) END)")} AS loss
    FROM ({_ALL_EPOCHS}) WHERE epoch = ({_BEST}) GROUP BY idx"""


@catalog.add(f"{_mlp_rounds()}\n{_PREDICTED}")
def mlp_train_predict(spark, sf_dir):
    return _train_predict(spark, sf_dir, networks.MLP)


_TRAIN_LOSSES = " UNION ALL ".join(f"SELECT 'train' AS kind, {r} AS step, avg(-ln(p)) AS loss FROM p_{r} WHERE hit" for r in range(EPOCHS * STEPS))
_VALID_LOSSES = " UNION ALL ".join(f"SELECT 'valid' AS kind, {e} AS step, loss FROM loss_{e}" for e in range(EPOCHS))


@catalog.add(f"{_mlp_rounds()}\nSELECT kind, step, {sql_places('loss')} AS loss FROM ({_TRAIN_LOSSES} UNION ALL {_VALID_LOSSES})")
def loss_series(spark, sf_dir):
    """The losses of every step and epoch of training the perceptron."""
    _, _, trained = _trained(spark, sf_dir, networks.MLP)
    return trained.losses.select("kind", "step", places("loss").alias("loss"))


@catalog.add(f"{_mlp_rounds()}\nSELECT step AS epoch, {sql_places('loss')} AS loss FROM ({_VALID_LOSSES}) WHERE step = ({_BEST})")
def best_epoch(spark, sf_dir):
    """The epoch whose parameters are kept, and its validation loss."""
    _, _, trained = _trained(spark, sf_dir, networks.MLP)
    return networks.best_epoch(trained.losses).select("epoch", places("loss").alias("loss"))


def _lstm_rounds() -> str:
    """The rounds of training the recurrent model, one set of parameter tables per round."""
    parts, r = _lstm_start(), 0
    for epoch in range(EPOCHS):
        parts.append(f"""order_{epoch} AS MATERIALIZED (
            SELECT p_partkey AS idx, (row_number() OVER (ORDER BY {sql_digest(f"'0:{epoch}:' || p_partkey")}, p_partkey) - 1) // size.batch AS batch
            FROM part, size)""")
        for batch in range(STEPS):
            parts.append(f"m_{r} AS MATERIALIZED (SELECT idx FROM order_{epoch} WHERE batch = {batch})")
            parts.extend([*_lstm_forward(str(r), r, f"m_{r}"), *_lstm_backward(str(r), r)])
            step = f"{RATE} / (SELECT count(*) FROM m_{r})"
            moved = ", ".join(f"any_value(a.{g}) - {step} * coalesce(sum(d.{g}), 0.0) AS {g}" for g in _GATES)
            carried = ", ".join(f"any_value(a.{g}) - {step} * sum(z.hv * d.{g}) AS {g}" for g in _GATES)
            parts.extend([
                f"""w_{r + 1} AS MATERIALIZED (
                    SELECT a.char_id, a.h, {moved} FROM w_{r} a
                    LEFT JOIN (SELECT * FROM d_{r} JOIN reads USING (idx, t)) d ON d.char_id = a.char_id AND d.h = a.h GROUP BY a.char_id, a.h)""",
                f"""u_{r + 1} AS MATERIALIZED (
                    SELECT a.k, a.h, {carried} FROM u_{r} a JOIN d_{r} d ON d.h = a.h JOIN z_{r} z ON z.idx = d.idx AND z.t = d.t AND z.k = a.k GROUP BY a.k, a.h)""",
                f"b_{r + 1} AS MATERIALIZED (SELECT a.h, {moved} FROM b_{r} a JOIN d_{r} d ON d.h = a.h GROUP BY a.h)",
                f"b2_{r + 1} AS MATERIALIZED (SELECT label_id, any_value(b.v) - {step} * sum(e) AS v FROM b2_{r} b JOIN e_{r} USING (label_id) GROUP BY label_id)",
                f"""w2_{r + 1} AS MATERIALIZED (
                    SELECT h, label_id, any_value(w.v) - {step} * sum(hv * e) AS v
                    FROM w2_{r} w JOIN e_{r} USING (label_id) JOIN s_{r}_{NAME_LEN} USING (idx, h) GROUP BY h, label_id)"""])
            r += 1
        parts.extend(_lstm_forward(f"epoch{epoch}", r, "truth"))
        parts.append(f"loss_{epoch} AS (SELECT avg(-ln(p)) AS loss FROM p_epoch{epoch} WHERE hit)")
    return ",\n".join(parts)


@catalog.add(f"{_lstm_rounds()}\n{_PREDICTED}")
def lstm_train_predict(spark, sf_dir):
    return _train_predict(spark, sf_dir, networks.LSTM)
