"""Composed plans: the reference's end-to-end runs expressed as one lazy DataFrame each."""
