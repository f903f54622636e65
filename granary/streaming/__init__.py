"""File streams with a checkpoint: each bronze file is processed once."""
