from mirrorset.plans.synthesis import Settings, synthesize

__all__ = ["Settings", "synthesize"]
