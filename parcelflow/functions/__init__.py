from parcelflow.functions import masking, times

__all__ = ["masking", "times"]
