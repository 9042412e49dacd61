from tallyframe.functions.labels import with_class_index, with_label_domain
from tallyframe.functions.settled import settled
from tallyframe.functions.text import cut_cell, double_text, required_text, vector_text
from tallyframe.functions.votes import majority_vote

__all__ = [
    "cut_cell",
    "double_text",
    "majority_vote",
    "required_text",
    "settled",
    "vector_text",
    "with_class_index",
    "with_label_domain",
]
