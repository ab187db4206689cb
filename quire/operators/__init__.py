"""quire.operators"""
