"""All parameters of the job in one place; every field has an effect."""

from __future__ import annotations

from dataclasses import dataclass

# The ordered segment labels (position = segment id), the alias
# label and the two known gender codes of the member base table.
SEGMENT_LABELS = ("60q", "60h", "70h", "80h", "90h", "95h", "00h", "-")
SEGMENT_ALIASES = (("05h", "00h"),)
GENDER_CODES = ("124000000020", "124000000010")


@dataclass(frozen=True)
class Config:
    # cleaning
    rating_min: float = 0.00005
    item_user_cap: int | None = 10_000  # None: no item is too popular
    items_per_member: int | None = 10  # None: all items
    # segments
    segment_labels: tuple[str, ...] = SEGMENT_LABELS
    segment_aliases: tuple[tuple[str, str], ...] = SEGMENT_ALIASES
    # graph
    drop_exact: int | None = None  # 1000 drops items with exactly that many users
    neighbours: int = 100
    # walks
    walks_per_node: int = 10
    walk_steps: int = 10
    strategy: str = "weighted"  # weighted | greedy | uniform
    dead_end: str = "renormalize"  # renormalize | leak
    seed: int = 42
    stage_every: int = 5  # write the walks out after this many steps
    # skip-gram
    vector_size: int = 128
    window: int = 5
    learning_rate: float = 0.025
    iterations: int = 2
    min_count: int = 1
    max_sentence_length: int = 1000
    softmax: str = "tree"  # tree (hierarchical) | negatives (sampled)
    # similarity
    lsh_tables: int = 10
    lsh_hashes_per_table: int = 4
    lsh_threshold: float = 0.01
    neighbours_out: int = 10

    @property
    def unknown_label(self) -> str:
        return self.segment_labels[-1]
