from .incremental import append_batch, refine_new_files

__all__ = ["append_batch", "refine_new_files"]
