from .running import running_group_costs, running_word_counts, start, text_stream

__all__ = ["running_group_costs", "running_word_counts", "start", "text_stream"]
