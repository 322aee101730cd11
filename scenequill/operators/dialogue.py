"""Chat turns to question and answer pairs, judge records, nested messages, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import order_of, sample
from ..functions.text import judge_score

MARK = "###The instruction to evaluate: "


def pending_pairs(conv: DataFrame) -> DataFrame:
    """conv_id, turn, question, answer: an assistant turn right after a user turn with text, other roles left out."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = conv.where(F.col("role").isin("user", "assistant")).select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumns({"before": F.lag("role").over(w), "question": F.lag("text").over(w)})
    return t.where((F.col("role") == "assistant") & (F.col("before") == "user") & (F.col("question") != "")).select("conv_id", "turn", "question", F.col("text").alias("answer"))


def adjacent_pairs(conv: DataFrame) -> DataFrame:
    """The same with every role counting as a turn: strict adjacency; empty texts pass."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = conv.withColumns({"after": F.lead("role").over(w), "answer": F.lead("text").over(w)})
    return t.where((F.col("role") == "user") & (F.col("after") == "assistant")).select("conv_id", "turn", F.col("text").alias("question"), "answer")


# The texts of a judge's record.
REFERENCE = "An exemplary response that accurately describes spatial relationships and distances with precise unit usage and reference accuracy."
INSTRUCTION = "Describe the spatial relationships and distances between objects in a given scene, noting the accuracy of distances, units, and spatial relationships."
CRITERIA = "Evaluates the model's ability to identify image content accurately, focusing on spatial awareness and units of distance."
SCORES = (
    "The response has significant inaccuracies in distance estimates and misunderstands spatial relationships.",
    "The response recognizes basic spatial relationships but struggles with accurate distance estimation and appropriate unit usage.",
    "The response correctly estimates distances and understands spatial relationships, with minor inaccuracies or unit errors.",
    "The response provides accurate distance estimations and correct spatial relationships with precise unit usage, minor details notwithstanding.",
    "The response demonstrates excellent comprehension by accurately and precisely detailing distances, spatial relationships, and units, aligning closely with reference measurements or expert evaluations.",
)
RUBRICS = "Evaluates the model's ability to accurately estimate distances, understand spatial relationships, and use appropriate units of measurement for distances." + "".join(f"\nScore {i}: {s}" for i, s in enumerate(SCORES, 1))
PREAMBLE = (
    "###Task Description:\nAn instruction (might include an Input inside it), a response to evaluate, a reference answer that gets a score of 5, and a score rubric representing an evaluation criterion is given.\n"
    "1. Write a detailed feedback that assesses the quality of the response strictly based on the given score rubric, not evaluating in general.\n"
    "2. After writing a feedback, write a score that is an integer between 1 and 5. You should refer to the score rubric.\n"
    "3. The output format should look as follows: Feedback: (write a feedback for criteria) [RESULT] (an integer number between 1 and 5)\n"
    "4. Please do not generate any other opening, closing, and explanations.\n"
)


def text_of(content: Column) -> Column:
    """The first non-empty text of a message's fragments (array<struct<text>>); empty without one."""
    return F.coalesce(F.get(F.filter(F.transform(content, lambda f: f["text"]), lambda t: t.isNotNull() & (t != "")), F.lit(0)), F.lit(""))


def judge_entries(pairs: DataFrame, image_dir: str = "images", image_ext: str = "png", reference: str = REFERENCE, rubrics: str = RUBRICS, instruction: str = INSTRUCTION, criteria: str = CRITERIA) -> DataFrame:
    """``pairs`` (row_idx, turn, question, answer) to judge records: row_idx, turn and 14 text columns. The image's name is the
    number of the row that the pair comes from."""
    lit = lambda v, name: F.lit(v).alias(name)
    return pairs.select(
        "row_idx",
        "turn",
        F.concat(F.lit(f"{image_dir}/"), F.col("row_idx").cast("string"), F.lit(f".{image_ext}")).alias("image"),
        F.concat(F.lit(PREAMBLE + MARK), "question").alias("instruction"),
        F.col("answer").alias("response to evaluate"),
        lit(reference, "reference answer"),
        lit(rubrics, "score rubrics"),
        lit(instruction, "orig_instruction"),
        F.col("answer").alias("original_response"),
        lit(reference, "orig_reference_answer"),
        lit(criteria, "orig_criteria"),
        *[lit(s, f"orig_score{i}_description") for i, s in enumerate(SCORES, 1)],
    )


def matched(entries: DataFrame, results: DataFrame) -> DataFrame:
    """Records and results (nth, text) joined by their numbers ``nth``: image, instruction, response_to_evaluate, score,
    feedback. What only one side has goes, and so do results without a score."""
    j = entries.join(results.select("nth", F.coalesce("text", F.lit("")).alias("feedback")), "nth").withColumn("score", judge_score(F.col("feedback")))
    return j.where("score IS NOT NULL").select("nth", "image", "instruction", F.col("response to evaluate").alias("response_to_evaluate"), "score", "feedback")


def scored_dataset(matches: DataFrame) -> DataFrame:
    """nth, images, messages: the request and response as the user's turn, the score and feedback as the answer."""
    ask = F.concat(F.lit("###Request: "), request_of(F.col("instruction")), F.lit("\n\n###Response: "), "response_to_evaluate")
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return matches.select("nth", F.col("image").alias("images"), F.array(turn("user", ask), turn("assistant", scored_text(F.col("score"), F.col("feedback")))).alias("messages"))


def request_of(instruction: Column) -> Column:
    """What follows the first marker, or all."""
    return F.when(F.contains(instruction, F.lit(MARK)), F.get(F.split(instruction, f"\\Q{MARK}\\E", 2), F.lit(1))).otherwise(instruction)


def scored_text(score: Column, feedback: Column) -> Column:
    shown = F.when(score == F.floor(score), score.cast("long").cast("string")).otherwise(score.cast("string"))
    return F.concat(F.lit("["), shown, F.lit("] "), feedback)


def messages_of(prompts: Column) -> Column:
    """array of "question Answer: answer" texts to nested messages; an image fragment stands in the first user turn."""
    part = lambda text, kind, index: F.struct(index.cast("long").alias("index"), text.cast("string").alias("text"), F.lit(kind).alias("type"))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))

    def both(p: Column, i: Column) -> Column:
        qa = F.split(p, "Answer: ", 2)
        text = part(F.trim(qa[0]), "text", F.lit(None))
        image = part(F.lit(None), "image", F.lit(0))
        user = F.when(i == 0, F.array(image, text)).otherwise(F.array(text))
        return F.array(turn("user", user), turn("assistant", F.array(part(F.trim(qa[1]), "text", F.lit(None)))))

    return F.flatten(F.transform(F.filter(prompts, lambda p: F.contains(p, F.lit("Answer: "))), both))


def has_image(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.exists(m["content"], lambda c: c["type"] == "image"))


def with_image(messages: Column) -> Column:
    """Messages with an image fragment at the front of the first user turn, unless there is one already."""
    image = F.struct(F.lit(0).cast("long").alias("index"), F.lit(None).cast("string").alias("text"), F.lit("image").alias("type"))
    first = F.array_position(F.transform(messages, lambda m: m["role"]), "user") - 1
    put = F.transform(messages, lambda m, i: F.when(i == first, F.struct(m["role"].alias("role"), F.concat(F.array(image), m["content"]).alias("content"))).otherwise(m))
    return F.when(has_image(messages), messages).otherwise(put)


def training_messages(df: DataFrame) -> DataFrame:
    """``df`` (messages, input, output) with ``messages``: those of the row if there are any, else a turn each from input and
    output, null if neither; an image stands in the first user turn."""
    part = lambda c: F.array(F.struct(F.lit(None).cast("long").alias("index"), c.alias("text"), F.lit("text").alias("type")))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), part(c).alias("content"))
    made = F.when(F.col("input").isNotNull() & F.col("output").isNotNull(), F.array(turn("user", F.col("input")), turn("assistant", F.col("output"))))
    return df.withColumn("messages", with_image(F.when(F.size(F.coalesce("messages", F.array())) > 0, F.col("messages")).otherwise(made)))


def has_messages(df: DataFrame) -> DataFrame:
    return df.where(F.size(F.coalesce("messages", F.array())) > 0)


def chosen_pair(pairs: DataFrame, seed: int = 0) -> DataFrame:
    """One drawn question and answer of each conversation; conversations without any have nulls, given ``conv_id``s join."""
    return pairs.groupBy("conv_id").agg(F.min_by(F.struct("turn", "question", "answer"), order_of(F.lit(seed), F.col("conv_id"), F.col("turn"))).alias("p")).select("conv_id", "p.*")


def reasoner_input(question: Column) -> Column:
    """A question as a reasoning model is asked it. The special tokens around it."""
    head = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>  detailed thinking on<|eot_id|><|start_header_id|>user<|end_header_id|>  "
    return F.concat(F.lit(head), question, F.lit("<|eot_id|><|start_header_id|>assistant<|end_header_id|>"))


def caption_questions(rows: DataFrame, questions: list[str], n: int = 3, seed: int = 0) -> DataFrame:
    """scene_id, nth, text from scene_id, captions array, regions array: one drawn set of max(1, min(n, all)) questions for each
    region whose caption is not blank. Arrays of different lengths are an error."""
    k = max(1, min(n, len(questions)))
    both = F.when(F.size("captions") == F.size("regions"), F.arrays_zip("captions", "regions")).otherwise(F.raise_error(F.lit("captions and regions differ in number")))
    one = rows.select("scene_id", F.posexplode(both).alias("at", "z")).where(F.trim("z.captions") != "")
    asked = one.select("scene_id", "at", "z.captions", F.posexplode(sample(F.array(*[F.lit(q) for q in questions]), k, F.lit(seed), F.col("scene_id"), F.col("at"))).alias("i", "q"))
    return asked.select("scene_id", (F.col("at") * k + F.col("i")).cast("long").alias("nth"), F.concat("q", F.lit(" Answer: "), "captions").alias("text"))
